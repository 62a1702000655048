"""The episode decision ledger: parse, quality, contract, duplicate, media, accept.

The outcome of an episode depends on the ones before it in two ways: a source's
contract is that of its first accepted episode, and a trajectory counts as a
duplicate only after an equal one was accepted. ``fold`` says so row by row;
``decide`` gives the same from the compact ledger rows (no frames) by rounds of
minima per fingerprint and source, one round more per source of mixed contracts at most.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinelake.session import cut_lineage


def trajectory_fingerprints(steps: DataFrame, episodes: DataFrame) -> DataFrame:
    """A digest of embodiment, times, states and actions per episode; source, text and media do not enter.

    Frames are digested one by one with their index and combined by sums of two
    independent hashes, so the digest merges map-side and an episode of any length
    needs no single task. Null, NaN and signed zeros stay apart.
    """
    raw = F.to_json(F.struct("frame_index", "step_time", "state", "action"), {"ignoreNullFields": "false"})
    per = steps.select("episode_key", F.xxhash64(raw).alias("a"), F.xxhash64(F.lit("#"), raw).alias("b"))
    sums = per.groupBy("episode_key").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("a").cast("decimal(20,0)")).alias("a"), F.sum(F.col("b").cast("decimal(20,0)")).alias("b"))
    return sums.join(episodes.select("episode_key", "embodiment"), "episode_key").select("episode_key", F.sha2(F.concat_ws("|", "embodiment", F.col("n").cast("string"), F.col("a").cast("string"), F.col("b").cast("string")), 256).alias("fingerprint"))


def fold(rows: Iterable[dict]) -> Iterator[dict]:
    """Decide episodes in order. Rows: source_id, episode_key, quality_ok, contract, fingerprint, media_ok."""
    contract: dict = {}
    seen: dict = {}
    for r in rows:
        sid, fp = r["source_id"], r["fingerprint"]
        out = {"source_id": sid, "episode_key": r["episode_key"], "outcome": "quarantined", "stage": None, "duplicate_of": None}
        if not r["quality_ok"]:
            out["stage"] = "quality"
        elif contract.get(sid, r["contract"]) != r["contract"]:
            out["stage"] = "contract"
        elif fp in seen:
            out.update(outcome="duplicate", duplicate_of=seen[fp])
        elif not r["media_ok"]:
            out["stage"] = "media"
        else:
            contract.setdefault(sid, r["contract"])
            seen[fp] = r["episode_key"]
            out["outcome"] = "accepted"
        yield out


def contract_of(state_dim: str = "state_dim", action_dim: str = "action_dim", state_names: str = "state_names", action_names: str = "action_names") -> Column:
    """An episode's contract as text: widths and channel names in order; without names the list is empty."""
    none = F.array().cast("array<string>")
    return F.to_json(F.struct(F.col(state_dim).alias("s"), F.col(action_dim).alias("a"), F.coalesce(state_names, none).alias("sn"), F.coalesce(action_names, none).alias("an")), {"ignoreNullFields": "false"})


def _fronts(rows: DataFrame) -> DataFrame:
    """``rows`` with ``first``, the earliest of equal fingerprint (hot ones after a map-side minimum)."""
    first = rows.groupBy("fingerprint").agg(F.min(F.struct("ord", "settled")).alias("first"))
    return rows.join(first, "fingerprint")


def _settle(possible: DataFrame) -> DataFrame:
    """The rows of ``possible`` (quality and media good) whose contract is that of their source's first accepted episode.

    A source with one contract left is settled. The earliest row of a fingerprint
    is accepted if its source is settled, so later equal rows go. Of an unsettled
    source the first row left names the contract if it is the earliest of its
    fingerprint; that holds for the first of all such rows, so every round settles
    a source and there are at most as many rounds as sources.
    """
    possible = possible.withColumn("settled", F.lit(True))
    while True:
        per = possible.groupBy("source").agg((F.min("contract") == F.max("contract")).alias("settled"))
        marked = cut_lineage(possible.drop("settled").join(per, "source"))
        if marked.where("not settled").isEmpty():
            return marked
        live = _fronts(marked).withColumn("front", F.col("ord") == F.col("first.ord")).where(F.col("front") | ~F.col("first.settled"))
        lead = live.where("not settled").groupBy("source").agg(F.min(F.struct("ord", "front", "contract")).alias("lead"))
        kept = live.join(lead, "source", "left").where("settled or not lead.front or contract = lead.contract")
        possible = kept.select("ord", "source", "episode_key", "contract", "fingerprint", "settled")


def decide(compact: DataFrame) -> DataFrame:
    """The ledger of ``compact``: ord, source_id, episode_key, quality_ok, contract, fingerprint, media_ok.

    Equal to ``fold``, without its one pass in order: the contract of each source is
    settled first, then joins over fingerprints and sources decide.
    """
    compact = compact.withColumn("source", F.to_json(F.struct("source_id")))  # a missing id is one source, too
    good = compact.where("quality_ok and media_ok").select("ord", "source", "episode_key", "contract", "fingerprint")
    accepted = _fronts(_settle(good)).where("ord = first.ord").select("ord", "source", "episode_key", "contract", "fingerprint")
    first = accepted.select("fingerprint", F.struct("ord", "episode_key").alias("first"))
    begun = accepted.groupBy("source").agg(F.min(F.struct("ord", "contract")).alias("begun"))
    e = compact.join(first, "fingerprint", "left").join(begun, "source", "left")
    at = F.col("first.ord")
    other = F.coalesce((F.col("begun.ord") < F.col("ord")) & (F.col("begun.contract") != F.col("contract")), F.lit(False))
    fits = F.col("quality_ok") & ~other
    outcome = F.when(fits & (F.col("ord") == at), "accepted").when(fits & (F.col("ord") > at), "duplicate").otherwise("quarantined")
    stage = F.when(~F.col("quality_ok"), "quality").when(other, "contract").when(at.isNull() | (F.col("ord") < at), "media")
    return e.select("ord", "source_id", "episode_key", outcome.alias("outcome"), stage.alias("stage"), F.when(fits & (F.col("ord") > at), F.col("first.episode_key")).alias("duplicate_of"))


def first_occurrence(df: DataFrame, key: str, content: str) -> DataFrame:
    """Each row's key with ``duplicate_of``, the smallest key of equal content (null for the first itself)."""
    firsts = df.where(F.col(content).isNotNull()).groupBy(content).agg(F.min(key).alias("first"))
    return df.join(firsts, content, "left").select(key, F.when(F.col("first") < F.col(key), F.col("first")).alias("duplicate_of"))


def source_order(sources: DataFrame, episodes: DataFrame) -> DataFrame:
    """Episodes with ``ord``, their place by batch and then key: a pair that is compared, so nothing has to be numbered."""
    batches = sources.groupBy("source_id", "revision").agg(F.min("batch_no").alias("batch_no"))
    e = episodes.join(batches, ["source_id", "revision"], "left").withColumn("batch_no", F.coalesce("batch_no", F.lit(2**31 - 1)))
    return e.withColumn("ord", F.struct("batch_no", "episode_key"))
