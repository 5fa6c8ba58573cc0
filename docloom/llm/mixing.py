"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

1. Every document falls by a seeded hash into one of its source's blocks of about BLOCK_WORDS words; above MOST_BLOCKS blocks in all, blocks
   grow, which at 100 TB makes them 2.5 times as large. A step coprime to the number of blocks permutes them; blocks without words are left out.
2. Sources share the corpus by weight; a target stops at MAX_REPEATS times its source, and the excess is shared again by weight.
   A source is drawn in whole passes over its blocks, each pass in a permutation of its own, then a last part of a pass that ends inside one
   block, there inside one document: that document gives its first words only, so the words taken are the target to the word.
3. The numbers of block draws of all sources are split among the output shards: a node of the tree halves its shards and draws
   how many of each source's blocks go left from the multivariate hypergeometric distribution, so that every shard has an exact
   quota and the shards together have exactly the draws of each source. A shard's draws are a run of the permuted draws.
4. Within a shard documents are ordered by another hash.

There are N_SHARDS shards, or as many as hold SHARD_WORDS words each if that is more. What is written to the checkpoint folder is an id, a source,
a size and a hash for each document, and a row for each block. The texts of mix() are dealt out once, to their shards. Driver: one row for each
source, at most MAX_SOURCES (the weights are a table of sources; more raise an error), and the tree's quotas, at most MOST_CELLS (where
sources times shards would be more, there are fewer, larger shards).

Defined results: a null text has size 0 and is never taken; a null source is a source of its own, last in order; repeated rows
are documents of their own; where the last part of a pass ends inside rows equal in id and text, each of them gives the same number of first
words, so that the words taken may miss the target by less than one word a copy; without rows or words every target is 0; two runs give the
same draws; columns may have any name, those of mix() stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, floor, gcd

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, SEPARATOR, cut, give_back, n_words_of, text_of

MAX_REPEATS = 3
BLOCK_WORDS = 20_000
#: The tree's generator draws from fewer than 1e9 blocks, and a block is drawn MAX_REPEATS times at most.
MOST_BLOCKS = 300_000_000
#: Blocks whose places are counted together.
GROUP_BLOCKS = 4096
MAX_SOURCES = 100_000
N_SHARDS = 64
SHARD_WORDS = 20_000_000
MOST_CELLS = 4_000_000
SEED = 20240117


def targets(sizes: list[int], weights: list[float], most: float = MAX_REPEATS) -> list[float]:
    """Shares of sum(sizes) by weight; what is above `most` times a size is shared again among the others."""
    out, open_, left = [0.0] * len(sizes), set(range(len(sizes))), float(sum(sizes))
    while open_:
        unit = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if unit * weights[i] >= most * sizes[i]]
        if not full:
            for i in open_:
                out[i] = unit * weights[i]
            break
        for i in full:
            out[i] = float(most * sizes[i])
        left = max(0.0, left - sum(most * sizes[i] for i in full))
        open_ -= set(full)
    return out


def splitting_tree(quotas: list[int], shards: int, seed: int = SEED) -> np.ndarray:
    """Draws of each source (rows) in each shard (columns): rows sum to the quotas, columns differ by one in all at most."""
    rng, out = np.random.Generator(np.random.PCG64(seed)), np.zeros((len(quotas), shards), dtype=np.int64)

    def split(pool: np.ndarray, first: int, last: int) -> None:
        if last - first == 1 or not pool.sum():
            out[:, first] = pool
            return
        middle = (first + last) // 2
        total = int(pool.sum())
        left = rng.multivariate_hypergeometric(pool, total * (middle - first) // (last - first), method="marginals") if total else pool
        split(left, first, middle)
        split(pool - left, middle, last)

    if len(quotas):
        split(np.asarray(quotas, dtype=np.int64), 0, shards)
    return out


def _coprime(blocks: int, after: int) -> int:
    """A step that permutes the places 0 .. blocks - 1 when they are multiplied by it."""
    return next(x for x in range(after, after + 2 * blocks + 9) if gcd(x, blocks) == 1)


@dataclass(frozen=True)
class Plan:
    """sources: one row for each source, with its target and how it is drawn; blocks: s, rank, part (words of the block in the last pass) and the shard
    of each of its draws; edges: the rows of the blocks in which a last pass ends, with the words that each gives."""

    sources: DataFrame
    blocks: DataFrame
    edges: DataFrame
    n_edges: int
    shards: int


def _placed(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """rows (source, h) with the plan of their source and the rank of their block."""
    named = sources.withColumnRenamed("source", "own_source")
    out = rows.join(F.broadcast(named), rows["source"].eqNullSafe(named["own_source"])).drop("own_source")
    return out.withColumn("rank", F.pmod(F.pmod("h", "blocks") * F.col("step"), F.col("blocks")))


def plan(sized: DataFrame, weights, shards: int | None = None, seed: int = SEED) -> Plan:
    """sized: id, source, size, h. weights(i) is the weight of the i-th source by code point."""
    spark = sized.sparkSession
    found = sized.groupBy("source").agg(F.sum("size").alias("size")).limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    found.sort(key=lambda r: (r.source is None, r.source or ""))
    sizes = [int(r["size"]) for r in found]
    goal = targets(sizes, [weights(i) for i in range(len(found))])
    block_words = max(BLOCK_WORDS, -(-sum(sizes) // MOST_BLOCKS))
    rows = []
    for i, (r, size, t) in enumerate(zip(found, sizes, goal, strict=True)):
        blocks, words = max(1, size // block_words), floor(t + 0.5)
        passes = words // size if size else 0
        rows.append((i, r.source, size, t, blocks, _coprime(blocks, blocks // 2 + 1 + i % 7), passes, words - passes * size))
    sources = spark.createDataFrame(rows, "s int, source string, source_size long, target double, blocks long, step long, passes long, rest long")

    # the place of each block with words among its source's, and the words before it: counted in groups, then over groups
    held = _placed(sized.filter("size > 0"), sources).groupBy("s", "rest", "rank").agg(F.sum("size").alias("words"))
    held = held.withColumn("g", F.floor(F.col("rank") / GROUP_BLOCKS))
    inside = Window.partitionBy("s", "g").orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = cut(held.withColumns({"n": F.count("*").over(inside) - 1, "before": F.sum("words").over(inside) - F.col("words")}))
    groups = held.groupBy("s", "g").agg(F.count("*").alias("gn"), F.sum("words").alias("gw"))
    over = Window.partitionBy("s").orderBy("g").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    groups = groups.select("s", "g", (F.sum("gn").over(over) - F.col("gn")).alias("gn"), (F.sum("gw").over(over) - F.col("gw")).alias("gw"))
    held = held.join(groups, ["s", "g"]).select("s", "rank", "words", "rest", (F.col("n") + F.col("gn")).alias("place"), (F.col("before") + F.col("gw")).alias("before"))
    held = cut(held.withColumn("part", F.least("words", F.greatest(F.lit(0), F.col("rest") - F.col("before")))))

    counted = {r.s: (r.n, r.k) for r in held.groupBy("s").agg(F.count("*").alias("n"), F.sum((F.col("part") > 0).cast("long")).alias("k")).collect()}
    n_blocks, drawn = ([counted.get(i, (0, 0))[k] for i in range(len(rows))] for k in range(2))
    passes = [r[6] for r in rows]
    quotas = [p * n + k for p, n, k in zip(passes, n_blocks, drawn, strict=True)]
    shards = shards or max(N_SHARDS, min(ceil(sum(floor(t + 0.5) for t in goal) / SHARD_WORDS), MOST_CELLS // max(1, len(rows))))
    ends = np.cumsum(splitting_tree(quotas, shards, seed), axis=1)
    steps = [[_coprime(n, n // 3 + 1 + 11 * k) if n else 1 for k in range(p)] for n, p in zip(n_blocks, passes, strict=True)]

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each block with the shards of its draws: by whole pass, then of the last part of a pass, -1 where it isn't drawn."""
        give_back()  # of the stage before
        for batch in batches:
            source, place = batch.column(0).to_numpy(), batch.column(4).to_numpy()
            order = np.argsort(source, kind="stable")
            found, lengths = [], np.zeros(len(source), np.int64)
            for at in np.split(order, np.flatnonzero(np.diff(source[order])) + 1) if len(source) else ():
                s, own = int(source[at[0]]), place[at]
                each = [np.searchsorted(ends[s], k * n_blocks[s] + (own * step + k) % n_blocks[s], side="right") for k, step in enumerate(steps[s])]
                last = np.where(own < drawn[s], np.searchsorted(ends[s], passes[s] * n_blocks[s] + own, side="right"), -1)
                found.append(np.column_stack([*each, last]).astype(np.int32).ravel())
                lengths[at] = len(each) + 1
            offsets = np.concatenate([[0], np.cumsum(lengths[order])]).astype(np.int32)
            shards = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found) if found else np.zeros(0, np.int32)))
            columns = [c.take(pa.array(order)) for c in batch.columns[:4]]
            yield pa.RecordBatch.from_arrays([*columns, shards], names=["s", "rank", "words", "part", "shards"])

    blocks = cut(held.select("s", "rank", "words", "part", "place").mapInArrow(dealt, "s int, rank long, words long, part long, shards array<int>"))

    # the blocks in which a last pass ends: what each row gives; rows equal in id and text count as one and share what they get
    ending = blocks.filter("part > 0 and part < words").select("s", "rank", "part")  # one for each source at most
    units = _placed(sized.filter("size > 0"), sources).join(F.broadcast(ending), ["s", "rank"]).groupBy("s", "rank", "part", "h", "id", "size").agg(F.count("*").alias("copies"))
    in_order = Window.partitionBy("s", "rank").orderBy("h", "id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.col("size") * F.col("copies")
    first = F.sum(total).over(in_order) - total
    given = F.floor(F.least(total, F.greatest(F.lit(0), F.col("part") - first)) / F.col("copies")).cast("long")
    edges = cut(units.select(F.col("h").alias("edge_h"), F.col("id").alias("edge_id"), given.alias("given")))
    return Plan(sources, blocks, edges, edges.count(), shards)


def _drawn(rows: DataFrame, planned: Plan, seed: int) -> DataFrame:
    """rows (id, source, size, h and others) with source_size, target, taken and draws."""
    small = lambda table, n: F.broadcast(table) if n <= BROADCAST_ROWS else table
    blocks = planned.blocks.select("s", "rank", (F.col("part") > 0).alias("last"), ((F.col("part") > 0) & (F.col("part") < F.col("words"))).alias("ends"), "shards")
    out = _placed(rows, planned.sources).join(small(blocks, blocks.count()), ["s", "rank"], "left")
    out = out.join(small(planned.edges, planned.n_edges), (F.col("h") == F.col("edge_h")) & F.col("id").eqNullSafe(F.col("edge_id")) & F.col("ends"), "left")
    some = F.col("size") > 0
    last_words = F.when(some & F.col("ends"), F.coalesce("given", F.lit(0).cast("long"))).when(some & F.col("last"), F.col("size")).otherwise(F.lit(0).cast("long"))

    def draw(shard: Column, n: Column) -> Column:
        own = F.when(n < F.col("passes"), F.col("size")).otherwise(F.col("last_words")).cast("long")
        return F.struct(n.cast("long").alias("n"), own.alias("words"), shard.alias("shard"), F.xxhash64(F.lit(seed + 1), n.cast("long"), F.col("h")).alias("place"))

    out = out.withColumn("last_words", last_words)
    made = F.filter(F.transform("shards", draw), lambda d: (d["shard"] >= 0) & (d["words"] > 0))
    none = F.expr("cast(array() as array<struct<n:bigint,words:bigint,shard:int,place:bigint>>)")
    taken = F.when(some, F.col("passes") * F.col("size") + F.col("last_words")).otherwise(F.lit(0)).cast("long")
    return out.withColumns({"draws": F.when(some, F.coalesce(made, none)).otherwise(none), "taken": taken})


def _row(docs: DataFrame, key: str, text: str, source: str, seed: int) -> list[Column]:
    return [F.col(key).alias("id"), F.col(source).cast("string").alias("source"), n_words_of(text_of(text)).alias("size"), F.xxhash64(F.lit(seed), F.col(key), text_of(text)).alias("h")]


def draws(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights=lambda i: i % 3 + 1, shards: int | None = None, seed: int = SEED) -> DataFrame:
    """One row per document: id, h (hash of id and text), size, source_size, target, taken, and draws: for each pass that takes the document, its
    number, the words taken, the shard and the place in the shard's order. weights(i) is the weight of the i-th source by code point."""
    sized = cut(docs.select(*_row(docs, key, text, source, seed)))
    return _drawn(sized, plan(sized, weights, shards, seed), seed).select("id", "h", "size", "source_size", "target", "taken", "draws")


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights=lambda i: i % 3 + 1, shards: int | None = None, seed: int = SEED) -> DataFrame:
    """The mix itself: a row for each draw, with the input's columns; a document drawn in part has its first words only. Partition k holds shard k in its
    order. The draws are found in the row, so that texts are dealt out once."""
    own = _row(docs, key, text, source, seed)
    planned = plan(cut(docs.select(*own)), weights, shards, seed)
    out = _drawn(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *own), planned, seed)
    out = out.select("row", "id", "h", "size", F.explode("draws").alias("draw"))
    body = F.col("row")[text]
    leading = F.when(body.rlike(f"^{SEPARATOR}"), 2).otherwise(1)
    rest = F.element_at(F.split(body, SEPARATOR, F.col("draw.words").cast("int") + leading), -1)
    first = F.substring(body, F.lit(1), F.length(body) - F.length(rest))
    part = F.when(F.col("draw.words") < F.col("size"), first).otherwise(body).cast(dict(docs.dtypes)[text])
    out = out.select(F.col("draw.shard").alias("shard"), F.col("draw.place").alias("place"), "id", "h", F.col("row").withField(f"`{text}`", part).alias("row"))
    return out.repartitionById(planned.shards, F.col("shard")).sortWithinPartitions("place", "h", "id").select("row.*")
