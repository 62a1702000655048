"""Filling fixed-capacity containers with a grouping genetic algorithm on islands.

Items are dealt to demes by a hash of their key. A deme evolves on several
islands at once; a solution is a grouping of its items into bins. Crossover
injects whole well-filled bins of one parent into the other, removes the bins
that hold one of their items a second time and puts displaced items back by best
fit, exchanging them for items that fill a bin less well. Islands keep their
population from epoch to epoch, and between epochs each sends its elite to the next.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinelake.llm.tokens import VOCABULARY, token_counts
from kinelake.session import change_points, column, cut_lineage, whole_groups

CAPACITY = 1024
#: Items of a deme on average, islands of a deme, epochs (migrations + 1), generations of an epoch, solutions of an island, elite sent on.
DEME, ISLANDS, EPOCHS, GENERATIONS, POPULATION, ELITE = 1500, 2, 3, 24, 8, 2
SOLUTION = "deme bigint, island int, kind int, item bigint, size int, fitness double, bins array<int>"


class Bins:
    """A grouping of item numbers; open bins by free space for best fit."""

    def __init__(self, capacity: int):
        self.capacity, self.bins, self.free = capacity, [], []
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.mask = 0

    def add_bin(self, items: list[int], used: int) -> None:
        free = self.capacity - used
        self.bins.append(items)
        self.free.append(free)
        self._open(len(self.bins) - 1, free)

    def _open(self, b: int, free: int) -> None:
        self.by_free[free].append(b)
        self.mask |= 1 << free

    def best_fit(self, item: int, size: int) -> None:
        fitting = self.mask >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            stack = self.by_free[free]
            b = stack.pop()
            if not stack:
                self.mask &= ~(1 << free)
            self.bins[b].append(item)
            self.free[b] = free - size
            self._open(b, free - size)
        else:
            self.add_bin([item], size)

    def fitness(self) -> float:
        """Mean squared fill: few full bins beat many half-full ones."""
        fill = 1.0 - np.asarray(self.free, float) / self.capacity
        return float(fill @ fill) / max(len(fill), 1)


def build(order: list[int], sizes: list[int], capacity: int) -> Bins:
    out = Bins(capacity)
    for i in order:
        out.best_fit(i, sizes[i])
    return out


def crossover(a: Bins, b: Bins, sizes: list[int], rng: np.random.Generator) -> Bins:
    """``a`` with some of ``b``'s best-filled bins; bins that hold one of their items again are dissolved."""
    rank = sorted(range(len(b.bins)), key=b.free.__getitem__)
    best = rank[: max(1, len(rank) // 2)]
    n = int(rng.integers(1, max(2, len(best) // 2 + 1)))
    chosen = [best[i] for i in rng.choice(len(best), n, replace=False)]
    injected = {i for k in chosen for i in b.bins[k]}
    kept, loose = [(list(b.bins[k]), b.free[k]) for k in chosen], []
    for items, free in zip(a.bins, a.free, strict=True):
        if injected.isdisjoint(items):
            kept.append((list(items), free))
        else:
            loose += [i for i in items if i not in injected]
    return settled(kept, loose, sizes, a.capacity, rng)


def mutate(a: Bins, sizes: list[int], rng: np.random.Generator) -> Bins:
    """Dissolve the worst bins and a few others, and settle their items again."""
    worst = sorted(range(len(a.bins)), key=lambda k: -a.free[k])[:3]
    dissolved = {*worst, *rng.integers(0, len(a.bins), 3).tolist()}
    kept, loose = [], []
    for k, (items, free) in enumerate(zip(a.bins, a.free, strict=True)):
        if k in dissolved:
            loose += items
        else:
            kept.append((list(items), free))
    return settled(kept, loose, sizes, a.capacity, rng)


def settled(kept: list[tuple[list[int], int]], loose: list[int], sizes: list[int], capacity: int, rng: np.random.Generator) -> Bins:
    """Displaced items back into the bins: first in exchange for one or two smaller ones of a bin that they fill better, then by best fit, greater ones first."""
    out = Bins(capacity)
    loose = sorted(loose, key=sizes.__getitem__)
    for k in rng.permutation(len(kept)).tolist():
        items, free = kept[k]
        while free and loose:
            swap = _exchange(items, free, loose, sizes)
            if swap is None:
                break
            leave, enter = swap
            free -= sum(sizes[i] for i in enter) - sum(sizes[i] for i in leave)
            items = [i for i in items if i not in leave] + list(enter)
            loose = sorted([i for i in loose if i not in enter] + list(leave), key=sizes.__getitem__)
        out.add_bin(items, capacity - free)
    for i in reversed(loose):
        out.best_fit(i, sizes[i])
    return out


#: Displaced items whose pairs are tried in an exchange (all are tried singly), and items of a bin.
PAIRED, CROWD = 48, 8


def _exchange(items: list[int], free: int, loose: list[int], sizes: list[int]) -> tuple[tuple[int, ...], tuple[int, ...]] | None:
    """The exchange of one or two items that leaves least free: (leaving, entering), or None if none fills the bin better."""
    some = items[:CROWD]
    out = [(i,) for i in some] + [(i, j) for n, i in enumerate(some) for j in some[n + 1 :]]
    sums = np.array([sum(sizes[i] for i in o) for o in out])
    inn = [(i,) for i in loose]
    few = loose[:: max(1, len(loose) // PAIRED)]
    inn += [(i, j) for n, i in enumerate(few) for j in few[n + 1 :]]
    gain = np.array([sum(sizes[i] for i in e) for e in inn])
    order = np.argsort(gain, kind="stable")
    ranked = gain[order]
    at = np.searchsorted(ranked, sums + free, "right") - 1
    more = np.where(at >= 0, ranked[np.maximum(at, 0)] - sums, -1)
    best = int(np.argmax(more))
    return (out[best], inn[order[at[best]]]) if more[best] > 0 else None


def decoded(genome: list[int], sizes: list[int], capacity: int) -> Bins:
    groups: dict[int, list[int]] = {}
    for i, b in enumerate(genome):
        groups.setdefault(b, []).append(i)
    made = Bins(capacity)
    for items in groups.values():
        made.add_bin(items, sum(sizes[i] for i in items))
    return made


def evolve(sizes: list[int], capacity: int, incoming: list[list[int]], seed: int, generations: int = GENERATIONS, population: int = POPULATION) -> list[Bins]:
    """The population after some generations, best first. ``incoming``: bins per item of the island's solutions and of migrants.

    Stops when no fewer bins are possible. Each generation two children take the
    place of the worst; the best always stay.
    """
    rng = np.random.default_rng(seed)
    n = len(sizes)
    rank = lambda s: (len(s.bins), -s.fitness())
    pop = [decoded(g, sizes, capacity) for g in incoming] or [build(sorted(range(n), key=lambda i: -sizes[i]), sizes, capacity)]
    pop = sorted(pop, key=rank)[:population]
    bound = -(-sum(sizes) // capacity)
    while len(pop) < population and len(pop[0].bins) > bound:
        blur = np.asarray(sizes) * rng.uniform(0.7, 1.0, n)
        pop.append(build(np.argsort(-blur).tolist(), sizes, capacity))
    for _ in range(generations):
        pop.sort(key=rank)
        if len(pop[0].bins) <= bound:
            break
        a, b = (min(rng.integers(0, len(pop), 2)) for _ in range(2))
        child = crossover(pop[a], pop[b], sizes, rng)
        other = mutate(crossover(pop[b], pop[a], sizes, rng), sizes, rng)
        pop = [*pop[: max(len(pop) - 2, 1)], child, other]
    return sorted(pop, key=rank)


def _genome(s: Bins, n: int) -> list[int]:
    out = [0] * n
    for b, items in enumerate(s.bins):
        for i in items:
            out[i] = b
    return out


def _epoch(items: DataFrame, elites: DataFrame | None, capacity: int, epoch: int, seed: int, demes: int) -> DataFrame:
    """One epoch on all islands: rows of each island's population (kind 1), `item` being its rank."""
    rows = items.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1)))).select("deme", "island", F.lit(0).alias("kind"), "item", "size", F.lit(None).cast("double").alias("fitness"), F.lit(None).cast("array<int>").alias("bins"))
    if elites is not None:
        # all solutions stay, the elite (ranks are in `item`) goes to the next island, too
        moved = F.when(F.col("item") < ELITE, F.array(F.struct(F.col("island").alias("to")), F.struct(((F.col("island") + 1) % ISLANDS).cast("int").alias("to")))).otherwise(F.array(F.struct(F.col("island").alias("to"))))
        rows = rows.unionByName(elites.withColumn("m", F.explode(F.array_distinct(moved))).withColumn("island", F.col("m.to")).drop("m"))
    spark = items.sparkSession
    parts = min(demes * ISLANDS, max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")), demes // 64))  # few bytes, much work: a number of its own keeps AQE from merging them
    keyed = rows.repartition(int(parts), "deme", "island").sortWithinPartitions("deme", "island", "kind", "item")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tbl in whole_groups(batches, ["deme", "island"], 1):
            deme, island, kind, size = (column(tbl, c) for c in ("deme", "island", "kind", "size"))
            starts = np.append(change_points(deme, island), len(deme))
            for s, e in zip(starts[:-1], starts[1:], strict=True):
                cut = s + int(np.searchsorted(kind[s:e], 1))
                sizes = size[s:cut].astype(int).tolist()
                incoming = tbl.column("bins").slice(cut, e - cut).to_pylist()
                pop = evolve(sizes, capacity, incoming, seed + 1009 * epoch + 31 * int(island[s]) + int(deme[s]))
                k = len(pop)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([deme[s]] * k, pa.int64()), pa.array([island[s]] * k, pa.int32()), pa.array([1] * k, pa.int32()), pa.array(range(k), pa.int64()), pa.array([len(p.bins) for p in pop[:k]], pa.int32()), pa.array([p.fitness() for p in pop[:k]], pa.float64()), pa.array([_genome(p, cut - s) for p in pop[:k]], pa.list_(pa.int32()))],
                    names=["deme", "island", "kind", "item", "size", "fitness", "bins"],
                )

    return keyed.mapInArrow(run, SOLUTION)


def pack(lengths: DataFrame, capacity: int = CAPACITY, seed: int = 11) -> DataFrame:
    """Pack items (doc_id, n_tokens) into sequences of ``capacity``.

    Returned, one row per document and piece: doc_id, piece, sequence, position
    (the piece's first place in its sequence), n_tokens. An item longer than the
    capacity is split into full pieces, each a sequence of its own, and a rest
    that is packed like an item; no other item is split. Items of length 0 (null
    or blank texts) have a null sequence and position. Repeated doc_ids count
    once, by their greatest length; null doc_ids give no row; extra columns are
    ignored; an empty table gives none.
    """
    once = cut_lineage(lengths.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.coalesce(F.max("n_tokens"), F.lit(0)).alias("n_tokens")))
    whole = F.floor(F.col("n_tokens") / capacity)
    doc = F.col("doc_id").cast("string")
    full = once.where(F.col("n_tokens") >= capacity).select("doc_id", F.explode(F.sequence(F.lit(0).cast("bigint"), whole - 1)).alias("piece"))
    full = full.select("doc_id", "piece", F.concat(F.lit("d"), doc, F.lit("-"), F.col("piece").cast("string")).alias("sequence"), F.lit(0).cast("bigint").alias("position"), F.lit(capacity).cast("bigint").alias("n_tokens"))
    none = once.where("n_tokens = 0").select("doc_id", F.lit(0).cast("bigint").alias("piece"), F.lit(None).cast("string").alias("sequence"), F.lit(None).cast("bigint").alias("position"), "n_tokens")
    rest = once.withColumn("size", (F.col("n_tokens") % capacity).cast("int")).where("size > 0")
    demes = max(1, -(-rest.count() // DEME))
    items = rest.select(F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(demes)).alias("deme"), F.col("doc_id").alias("item"), "size", whole.alias("piece"))
    elites = None
    for epoch in range(EPOCHS):
        elites = cut_lineage(_epoch(items.select("deme", "item", "size"), elites, capacity, epoch, seed, demes))
    best = elites.groupBy("deme").agg(F.min_by("bins", F.struct("size", -F.col("fitness"), "island", "item")).alias("bins"))
    ordered = items.groupBy("deme").agg(F.array_sort(F.collect_list(F.struct("item", "size", "piece"))).alias("items"))  # a deme is bounded
    placed = ordered.join(best, "deme").select("deme", F.explode(F.arrays_zip("items", "bins")).alias("z"))
    placed = placed.select("deme", F.col("z.bins").alias("bin"), F.col("z.items.item").alias("doc_id"), F.col("z.items.size").alias("size"), F.col("z.items.piece").alias("piece"))
    w = Window.partitionBy("deme", "bin").orderBy(F.desc("size"), "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.select("doc_id", "piece", F.concat(F.lit("s"), F.col("deme").cast("string"), F.lit("-"), F.col("bin").cast("string")).alias("sequence"), F.coalesce(F.sum("size").over(w), F.lit(0)).alias("position"), F.col("size").cast("bigint").alias("n_tokens"))
    return full.unionByName(placed).unionByName(none)


def pack_documents(documents: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """``pack`` for whole texts measured in tokens."""
    return pack(token_counts(documents, vocabulary), capacity)


def fill_report(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """sequences, tokens, fill (share of all places used)."""
    used = packed.where(F.col("sequence").isNotNull())
    return used.agg(F.count_distinct("sequence").alias("sequences"), F.sum("n_tokens").alias("tokens")).withColumn("fill", F.col("tokens") / (F.col("sequences") * capacity))


def pack_checks(lengths: DataFrame, packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Per document: ``complete`` (its pieces hold each token once, and it is split only where longer than the capacity) and ``fits`` (its sequences are filled without gap or overlap, up to the capacity at most)."""
    used = packed.where(F.col("sequence").isNotNull()).groupBy("sequence").agg(((F.sum("n_tokens") <= capacity) & (F.sum("n_tokens") == F.max(F.col("position") + F.col("n_tokens"))) & (F.count_distinct("position") == F.count(F.lit(1)))).alias("good"))
    per = packed.join(used, "sequence", "left").groupBy("doc_id").agg(F.sum("n_tokens").alias("placed"), F.count_distinct("piece").alias("pieces"), F.bool_and(F.coalesce("good", F.col("sequence").isNull() & (F.col("n_tokens") == 0))).alias("fits"))
    known = lengths.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.coalesce(F.max("n_tokens"), F.lit(0)).alias("n"))
    complete = (F.col("placed") == F.col("n")) & (F.col("pieces") == F.greatest(F.ceil(F.col("n") / capacity), F.lit(1)))
    return known.join(per, "doc_id", "left").select("doc_id", F.coalesce(complete, F.lit(False)).alias("complete"), F.coalesce("fits", F.lit(False)).alias("fits"))
