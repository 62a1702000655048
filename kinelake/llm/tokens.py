"""Token counts with a public rank file; the file's path is a parameter."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinelake.session import spread

VOCABULARY = os.environ.get("KINELAKE_VOCABULARY", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")
#: Fixed value: the pattern that splits text before the merges of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def token_counts(documents: DataFrame, vocabulary: str = VOCABULARY, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_tokens (0 for null texts) and the columns in ``keep``; whole texts are counted."""
    with open(vocabulary, "rb") as f:
        ranks_file = documents.sparkSession.sparkContext.broadcast(f.read())  # about 1 MB, whatever the data

    kept = documents.select("doc_id", "text", *keep)
    schema = kept.drop("text").withColumn("n_tokens", F.lit(0).cast("bigint")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = None
        for batch in batches:
            if encoding is None:
                import tiktoken

                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks_file.value.splitlines())}
                encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
            texts = batch.column(1).to_pylist()
            counts = np.array([len(encoding.encode_ordinary(t)) if t else 0 for t in texts], np.int64)
            columns = [batch.column(i) for i in range(batch.num_columns) if i != 1]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts)], names=[f.name for f in schema])

    return spread(kept).mapInArrow(run, schema)
