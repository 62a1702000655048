"""Sessions, shared scratch space and sorted Arrow streams.

Everything here follows the session it is given: the checkpoint folder is read
from ``spark.checkpoint.dir`` and only set where it is unset (local tests).
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "kinelake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC, AQE and a shuffle width that fits the master."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's shared folder; make a private one only where none is named."""
    if spark.sparkContext.getCheckpointDir():
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="kinelake-checkpoint-")
    spark.sparkContext.setCheckpointDir(named)


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A new path in the shared checkpoint folder, removed when Python ends."""
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{kind}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a table in the shared checkpoint folder and read it back from there.

    Unlike a checkpoint this computes the last stage once, and later plans know the
    table's size. The folder belongs to the application and goes when Python ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_written: list[tuple[SparkSession, str]] = []


@atexit.register
def _remove_written() -> None:
    for spark, path in _written:
        try:
            jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
            jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)
        except Exception:  # the session may have ended before
            return


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores where the input has fewer splits than that; else as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table of a data folder, one file or a folder of files."""
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))


def change_points(*keys: np.ndarray) -> np.ndarray:
    """Positions at which a run of equal keys starts, in rows sorted by the keys."""
    n = len(keys[0])
    new = np.zeros(n, bool)
    if n:
        new[0] = True
        for key in keys:
            new[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(new)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], min_rows: int = 20_000) -> Iterator[pa.Table]:
    """Re-cut a stream sorted by ``keys`` (integers, not null) into tables of whole groups.

    Memory holds one group plus about ``min_rows`` rows, whatever the partition's size.
    """
    held: list[pa.RecordBatch] = []
    rows = 0
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        starts = change_points(*columns)
        head = tuple(c[0] for c in columns)
        cut = int(starts[-1]) if len(starts) > 1 or head != last else -1
        if rows + max(cut, 0) >= min_rows and cut >= 0:
            if cut:
                held.append(batch.slice(0, cut))
            if held:
                yield pa.Table.from_batches(held)
            held, rows = [batch.slice(cut)], batch.num_rows - cut
        else:
            held.append(batch)
            rows += batch.num_rows
        last = tuple(c[-1] for c in columns)
    if held:
        yield pa.Table.from_batches(held)


def column(tbl: pa.Table, name: str) -> np.ndarray:
    """A numeric column as numpy; nulls become NaN in floating columns."""
    col = tbl.column(name)
    return col.to_numpy() if isinstance(col, pa.ChunkedArray) else col.to_numpy(zero_copy_only=False)


def vectors(tbl: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """A list column as (flat values, offsets); a null list is an empty one, a null element NaN."""
    col = tbl.column(name).combine_chunks()
    if isinstance(col, pa.ChunkedArray):
        col = col.chunk(0) if col.num_chunks else pa.array([], col.type)
    lengths = col.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat, offsets


def padded(flat: np.ndarray, offsets: np.ndarray, width: int | None = None) -> np.ndarray:
    """Ragged rows as a matrix, NaN where a row is shorter."""
    lengths = np.diff(offsets)
    width = int(lengths.max(initial=0)) if width is None else width
    out = np.full((len(lengths), width), np.nan)
    if len(flat):
        row = np.repeat(np.arange(len(lengths)), lengths)
        col = np.arange(len(flat)) - np.repeat(offsets[:-1], lengths)
        keep = col < width
        out[row[keep], col[keep]] = flat[keep]
    return out
