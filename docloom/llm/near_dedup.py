"""Near-duplicate classes by BagMinHash signatures of weighted five-word shingles.

1. Texts with the same words are one node: a group of copies, however large, is counted and then stands as a single text.
2. A node's signature has COMPONENTS values. Every distinct shingle with its count as weight is a set of Poisson processes over the
   discretised weight axis, split into dyadic levels (0, 1], (1, 2], (2, 4] ...; a level's points carry a time, a component and a weight,
   and those above the shingle's count are thinned out. A component's value is the least time of any point, so that two multisets
   agree in it with probability equal to their weighted Jaccard similarity. Points are made in order of time and only while they
   can still lower the signature: about m ln m points a text, not m for every shingle.
3. BANDS bands of COMPONENTS / BANDS values are hashed to buckets. At a similarity of 0.8 a pair shares none with probability 3e-6.
4. Links are verified on the full shingle multisets. First the members of a bucket are compared with its leader, their least node, and
   linked nodes become components. Members of a bucket that are then in different components are dealt out in blocks of bounded size,
   and a task compares two blocks: only pairs of different components that share one of their rarest shingles (the prefix filter,
   which loses no pair) and that no earlier link joins. No pair inside a component is made, no pair is written unless it is a
   link, and no cap is set. A block's shingle sets are sent to each task that compares it, so that what is shuffled here grows with the
   square of a cluster of unlinked texts, divided by BLOCK_NODES.
5. Components are found by contracting links within partitions, then by alternating large-star and small-star steps in Spark.

What is written to the checkpoint folder: hashes and band values of each text, and the shingle hashes of texts with a candidate pair.

Defined results: texts of one to four words have one shingle, all their words; null and wordless texts have none and are each alone in
their class; a class is named by its least id (null ids are passed over); repeated rows are copies of one another; extra columns
are kept by near_dedup(), whatever their names; very long texts are read whole, a few megabytes of text at a time; an empty table gives no classes.
Copies, buckets, classes and clusters with more than a share of all rows meet what belongs to their key by broadcast (common.spread).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import bloom
from .common import cut, discard, give_back, saved, spread, text_of
from .suffix_dedup import mix
from .toxicity import slices

SHINGLE = 5
BANDS = 32
COMPONENTS = 160
THRESHOLD = 0.8
#: Nodes and bytes of shingles in a block; two blocks meet in a task.
BLOCK_NODES, BLOCK_BYTES = 2048, 16 << 20
#: Links that one task contracts.
CONTRACT_EDGES = 500_000
#: Candidate pairs looked at together in a task.
TILE_PAIRS = 2_000_000

_P = np.uint64(0x9E3779B97F4A7C15)


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number, shingle and count of the distinct shingles, in order of text and shingle; and two hashes of each text's word sequence (0, 0 for no word)."""
    n = len(texts)
    split = pc.ascii_split_whitespace(texts)
    words = split.flatten()
    kept = pc.not_equal(words, "")
    before = np.concatenate([[0], np.cumsum(kept.to_numpy(zero_copy_only=False).astype(np.int64))])
    offsets = before[np.asarray(split.offsets)]
    words = words.filter(kept).dictionary_encode()
    each = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words.dictionary.cast(pa.binary()).to_pylist()), np.uint64, len(words.dictionary))
    w = each[words.indices.to_numpy(zero_copy_only=False)] if len(words) else np.zeros(0, np.uint64)
    count = np.diff(offsets)
    doc = np.repeat(np.arange(n), count)
    # windows of five words, and one shorter window for texts of one to four
    h = np.zeros(max(0, len(w) - SHINGLE + 1), np.uint64)
    for k in range(SHINGLE):
        h = mix(h, w[k : k + len(h)])
    whole = np.flatnonzero(np.arange(len(h)) + SHINGLE <= offsets[doc[: len(h)] + 1]) if len(h) else np.zeros(0, np.int64)
    d, s = doc[whole], h[whole]
    short = np.flatnonzero((count > 0) & (count < SHINGLE))
    if len(short):
        own = np.full(len(short), 1, np.uint64)
        for k in range(SHINGLE - 1):
            has = count[short] > k
            own[has] = mix(own[has], w[offsets[short[has]] + k] + np.uint64(k + 1))
        d, s = np.concatenate([d, short]), np.concatenate([s, own])
    by = np.lexsort((s, d))
    d, s = d[by], s[by]
    first = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (s[1:] != s[:-1])])) if len(d) else np.zeros(0, np.int64)
    times = np.diff(np.append(first, len(d)))
    # hashes of the sequence: sums of words mixed with their places
    place = (np.arange(len(w)) - offsets[doc]).astype(np.uint64)
    sums = np.zeros((2, n), np.uint64)
    some = np.flatnonzero(count > 0)
    if len(some):
        for k in range(2):
            sums[k, some] = np.add.reduceat(mix(w + np.uint64(k), place * _P + np.uint64(k + 7)), offsets[some])
    return d[first], s[first], times, sums


def signatures(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, m: int = COMPONENTS) -> np.ndarray:
    """n rows of m least times; rows of texts without elements stay infinite."""
    sig = np.full(n * m, np.inf)
    if not len(doc):
        return sig.reshape(n, m)
    # one process for each element and weight level up to its weight; part: the share of the level's weights that count
    level = np.zeros(len(doc), np.int64)
    parts = [(doc, element, level, np.ones(len(doc)))]
    low, k, left = 1, 1, weight > 1
    while left.any():
        part = np.minimum(1.0, (weight[left] - low) / low)
        parts.append((doc[left], element[left], np.full(left.sum(), k), part))
        low, k = 2 * low, k + 1
        left = weight > low
    doc, element, level, part = (np.concatenate(x) for x in zip(*parts, strict=True))
    seed = mix(element, (level + 1).astype(np.uint64) * _P)
    rate = np.where(level == 0, 1.0, 2.0 ** np.maximum(level - 1, 0))
    x = np.zeros(len(doc))
    turn = 0
    highest = np.full(n, np.inf)
    while len(doc):
        turn += 1
        u = mix(seed, np.full(1, turn, np.uint64) * _P)
        v = mix(u, seed)
        x = x - np.log(((u >> np.uint64(11)).astype(np.float64) + 0.5) / 2**53) / rate
        live = x < highest[doc]
        if not live.all():
            doc, seed, part, rate, x, v = doc[live], seed[live], part[live], rate[live], x[live], v[live]
            if not len(doc):
                break
        component = ((v >> np.uint64(40)) % np.uint64(m)).astype(np.int64)
        counts = ((v & np.uint64(0xFFFFFFFF)).astype(np.float64) + 0.5) / 2**32 < part
        np.minimum.at(sig, (doc * m + component)[counts], x[counts])
        here = np.unique(doc)
        highest[here] = sig.reshape(n, m)[here].max(axis=1)
    return sig.reshape(n, m)


def band_values(sig: np.ndarray, bands: int = BANDS) -> np.ndarray:
    bits = sig.view(np.uint64).reshape(len(sig), bands, -1)
    out = np.arange(1, bands + 1, dtype=np.uint64)[None, :] * _P + np.zeros((len(sig), 1), np.uint64)
    for k in range(bits.shape[2]):
        out = mix(out, np.ascontiguousarray(bits[:, :, k]))
    return out.view(np.int64)


def multiset(element: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Sorted distinct numbers, one for each element and occurrence: intersections of such sets are those of the multisets."""
    if times.max(initial=1) > 1:
        nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        element = mix(np.repeat(element, times), nth.astype(np.uint64) * _P)
    else:
        element = mix(element, np.zeros(len(element), np.uint64))
    return np.sort(element)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) or len(b) else 0.0


def contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (a, b) of one partition as (node, least node reached in this partition)."""
    table = pa.Table.from_batches(list(batches), pa.schema([("a", pa.int64()), ("b", pa.int64())]))
    a, b = table.column(0).to_numpy(), table.column(1).to_numpy()
    names, code = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = code[: len(a)], code[len(a) :]
    root = np.arange(len(names))
    while True:  # every root takes the least root next to it, then paths are cut short
        low = np.minimum(root[u], root[v])
        new = root.copy()
        np.minimum.at(new, root[u], low)
        np.minimum.at(new, root[v], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        new = new[root]
        if np.array_equal(new, root):
            break
        root = new
    moved = np.flatnonzero(root != np.arange(len(names)))
    yield pa.RecordBatch.from_arrays([pa.array(names[moved]), pa.array(names[root[moved]])], names=["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """links: a, b. node and component (the least node reached) of every node with a link."""
    edges = cut(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    # partitions of at most CONTRACT_EDGES edges shrink to stars by themselves; with one partition that is all
    parts = -(-edges.count() // CONTRACT_EDGES)
    own = edges.coalesce(1) if parts <= 1 else edges.repartition(parts)
    edges = cut(own.mapInArrow(contracted, "a long, b long"))
    before = None
    while parts > 1:
        # large star: a node's larger neighbours move to its least one
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        # small star: a node and its smaller neighbours move to the least of these
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").unionByName(least.select("a", F.col("m").alias("b"))).distinct()
        edges = cut(small)
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _read(texts: DataFrame, bands: int, m: int) -> DataFrame:
    """texts: who (a struct that names the row) and text. who's fields, g1, g2 (hashes of the words), n (shingles) and the band values."""
    schema = T.StructType([texts.schema["who"], *T.StructType.fromDDL("g1 long, g2 long, n long, bands array<long>")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                d, s, times, g = shingles(part.column(1))
                values = band_values(signatures(d, s, times, part.num_rows, m), bands)
                n = np.bincount(d, times, minlength=part.num_rows).astype(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, values.size + 1, bands, dtype=np.int32)), pa.array(values.ravel()))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(g[0].view(np.int64)), pa.array(g[1].view(np.int64)), pa.array(n), lists], names=schema.names)

    return texts.select("who", "text").mapInArrow(run, schema).select("who.*", "g1", "g2", "n", "bands")


def _shingle_sets(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """node and its shingles (sorted 64-bit numbers as bytes) of the nodes in `wanted` (node, g1, g2)."""
    likely = bloom.Bits(wanted, "g1", wanted.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                d, s, times, g = shingles(part.column(0))
                ok = np.flatnonzero(likely.has(g[0]))
                ok = ok[np.sort(np.unique(g[0][ok] ^ g[1][ok], return_index=True)[1])]
                at = np.searchsorted(d, ok, side="left"), np.searchsorted(d, ok, side="right")
                sets = [multiset(s[a:b], times[a:b]).tobytes() for a, b in zip(at[0].tolist(), at[1].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(g[0][ok].view(np.int64)), pa.array(g[1][ok].view(np.int64)), pa.array(sets, pa.binary())], names=["g1", "g2", "shingles"])

    return texts.select("text").mapInArrow(run, "g1 long, g2 long, shingles binary").join(wanted, ["g1", "g2"]).groupBy("node").agg(F.first("shingles").alias("shingles"))


def _verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose multisets are at least `threshold` alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(2), batch.column(3)
            alike = [similarity(np.frombuffer(a[i].as_buffer(), np.uint64), np.frombuffer(b[i].as_buffer(), np.uint64)) >= threshold for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(alike, pa.bool_())) for c in batch.columns[:2]], names=["a", "b"])
        give_back()

    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def near_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, bands: int = BANDS, m: int = COMPONENTS) -> DataFrame:
    """One row per input row: key, class_id, class_size, n_links, kept, and two hashes of the text. n_links counts the verified links
    that its text was joined by: to a bucket's leader, or between components. Alike pairs inside a component aren't compared, so it is not the
    number of all texts alike."""
    texts = docs.select(F.col(key).alias("id"), text_of(text).alias("text"))
    who = F.struct("id", F.monotonically_increasing_id().alias("row"), *_hashes(F.col("text")))
    read, read_path = saved(_read(texts.select(who.alias("who"), "text"), bands, m))
    worded, n_rows = read.filter("n > 0"), read.count()
    nodes = cut(worded.groupBy("g1", "g2").agg(F.min("row").alias("node"), F.count("*").alias("size")))
    named = spread(worded.select("id", "row", "t1", "t2", "g1", "g2"), nodes, ["g1", "g2"], n_rows).select("id", "row", "t1", "t2", "node")
    own = cut(named.unionByName(read.filter("n = 0").select("id", "row", "t1", "t2", F.col("row").alias("node"))))
    heads = read.join(nodes.select("node"), F.col("row") == F.col("node"), "left_semi")
    members = heads.select(F.col("row").alias("node"), F.explode("bands").alias("bucket"))
    shared = cut(members.groupBy("bucket").agg(F.min("node").alias("leader"), F.count("*").alias("size")).filter("size > 1"))
    held = cut(spread(members, shared, ["bucket"], bands * n_rows).select("bucket", "node", "leader"))
    links = sets_path = None
    if not held.isEmpty():
        wanted = heads.join(held.select("node").distinct(), F.col("row") == F.col("node"), "left_semi").select(F.col("row").alias("node"), "g1", "g2", "n")
        wanted = cut(wanted)
        sets, sets_path = saved(_shingle_sets(texts, wanted))
        links = _links(held, wanted.select("node", "n"), sets, threshold)
    if links is None:
        out = own.withColumn("component", F.col("node")).withColumn("n_links", F.lit(0).cast("long"))
    else:
        found = components(links).withColumnRenamed("component", "c")
        degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("n_links"))
        # by the links' nodes, and the rows of each: a node with many rows is sent to all tasks
        labelled = cut(found.join(degree, "node", "left").join(own.groupBy("node").agg(F.count("*").alias("size")), "node"))
        linked = spread(own, labelled, ["node"], n_rows).select("id", "row", "t1", "t2", F.col("c").alias("component"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))
        alone = own.join(labelled.select("node"), "node", "left_anti").select("id", "row", "t1", "t2", F.col("node").alias("component"), F.lit(0).cast("long").alias("n_links"))
        out = linked.unionByName(alone)
    out = cut(out.select("id", "row", "t1", "t2", "component", "n_links"))
    classes = cut(out.groupBy("component").agg(F.min("id").alias("class_id"), F.min(F.struct(F.col("id").isNull().alias("z"), "id", "row"))["row"].alias("stays"), F.count("*").alias("class_size")))
    for path in filter(None, (read_path, sets_path)):
        discard(docs.sparkSession, path)
    out = spread(out, classes, ["component"], n_rows, "class_size")
    return out.select(F.col("id").alias(key), "class_id", "class_size", "n_links", (F.col("row") == F.col("stays")).alias("kept"), "t1", "t2")


def _hashes(text: Column) -> tuple[Column, Column]:
    return F.xxhash64(text).alias("t1"), F.xxhash64(F.lit("second"), text).alias("t2")


def _links(held: DataFrame, sizes: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Verified links among bucket members (bucket, node, leader): enough of them that every pair alike is joined by a chain of links."""
    pairs = held.filter("node <> leader").select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct()
    na, nb = sizes.select(F.col("node").alias("a"), F.col("n").alias("na")), sizes.select(F.col("node").alias("b"), F.col("n").alias("nb"))
    fit = pairs.join(na, "a").join(nb, "b").filter(F.least("na", "nb") >= threshold * F.greatest("na", "nb")).select("a", "b")
    links = cut(_verified(fit, sets, threshold))

    # what is left: pairs of different components in one bucket, neither of them the leader
    label = components(links)
    labelled = cut(held.filter("node <> leader").join(label, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("c")))
    others = labelled.groupBy("bucket").agg(F.min("c").alias("c1"), F.max("c").alias("c2"), F.min("node").alias("b"), F.count("*").alias("size")).filter("c1 <> c2")
    left = cut(spread(labelled, cut(others.select("bucket", "b", "size")), ["bucket"], labelled.count()).select("node", "c", "b"))
    if left.isEmpty():
        return links
    cluster = components(left.select(F.col("node").alias("a"), "b"))  # nodes that share buckets, step by step
    nodes = left.select("node", "c").distinct().join(cluster.withColumnRenamed("component", "cluster"), "node").join(sizes, "node")
    nodes = cut(nodes)
    blocks = cut(nodes.groupBy("cluster").agg(F.count("*").alias("size"), F.ceil(F.greatest(F.count("*") / BLOCK_NODES, F.sum("n") * 8 / BLOCK_BYTES)).cast("int").alias("blocks")))
    placed = spread(nodes, blocks, ["cluster"], nodes.count()).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    tiles = placed.select("cluster", "node", "c", "block", other).select("cluster", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "c", (F.col("block") <= F.col("other")).alias("first"))
    tiles = tiles.withColumn("tile", F.xxhash64("cluster", "i", "j")).join(sets, "node").select("tile", "cluster", "i", "j", "node", "c", "first", "shingles")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:  # in order of tile: all but the last tile's rows are complete
            held.append(batch)
            tile = batch.column(0).to_numpy()
            if len(tile) and (tile[-1] != tile[0] or held[0].column(0)[0].as_py() != tile[0]):
                table = pa.Table.from_batches(held).combine_chunks()
                tile = table.column(0).to_numpy()
                starts = np.flatnonzero(np.concatenate([[True], tile[1:] != tile[:-1]]))
                for x, y in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                    yield of_tile(table.slice(x, y - x))
                held = table.slice(int(starts[-1])).to_batches()
        if held:
            yield of_tile(pa.Table.from_batches(held))
        give_back()

    def of_tile(table: pa.Table) -> pa.RecordBatch:
        node, c, first = (table.column(k).to_numpy() for k in ("node", "c", "first"))
        own = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
        same = table.column("i")[0] == table.column("j")[0]
        found = links_of_tile(own, c, None if same else first, threshold)
        return pa.RecordBatch.from_arrays([pa.array(np.maximum(node[found[:, 0]], node[found[:, 1]])), pa.array(np.minimum(node[found[:, 0]], node[found[:, 1]]))], names=["a", "b"])

    more = tiles.repartition("tile").sortWithinPartitions("tile").mapInArrow(run, "a long, b long")
    return cut(links.unionByName(more).distinct())


def links_of_tile(sets: list[np.ndarray], component: np.ndarray, side: np.ndarray | None, threshold: float) -> np.ndarray:
    """Pairs (places in `sets`) of different components, and of different sides if there are sides, that are alike: enough that every alike
    pair is joined by a chain. Only pairs that share one of their rarest shingles are compared: multisets of n >= m shingles that are
    alike share one of the (1 - t) n + 1 rarest of the first and the (1 - 2t / (1 + t)) m + 1 rarest of the second."""
    n = len(sets)
    size = np.array([len(s) for s in sets], dtype=np.int64)
    owner = np.repeat(np.arange(n), size)
    _, code, count = np.unique(np.concatenate(sets) if n else np.zeros(0, np.uint64), return_inverse=True, return_counts=True)
    by = np.lexsort((code, count[code], owner))
    code, owner = code[by], owner[by]
    place = np.arange(len(code)) - np.repeat(np.cumsum(size) - size, size)
    repeated = count[code] > 1
    probe = np.flatnonzero(repeated & (place < (size - np.ceil(threshold * size - 1e-9) + 1)[owner]))
    index = np.flatnonzero(repeated & (place < (size - np.ceil(2 * threshold / (1 + threshold) * size - 1e-9) + 1)[owner]))
    probe, index = probe[np.argsort(code[probe], kind="stable")], index[np.argsort(code[index], kind="stable")]
    lo, hi = np.searchsorted(code[probe], code[index], "left"), np.searchsorted(code[probe], code[index], "right")
    # union-find over the given components, so that pairs joined by earlier links aren't compared
    names, root = np.unique(component, return_inverse=True)
    parent = np.arange(len(names))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = int(parent[x])
        return x

    out: list[tuple[int, int]] = []
    seen = np.zeros(0, np.int64)
    at = 0
    ends = np.cumsum(hi - lo)
    while at < len(index):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + TILE_PAIRS, "right")))
        k = hi[at:stop] - lo[at:stop]
        a = np.repeat(owner[index[at:stop]], k)
        b = owner[probe[np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k) + np.repeat(lo[at:stop], k)]]
        at = stop
        top = np.array([find(x) for x in range(len(names))])[root]
        ok = (top[a] != top[b]) & (np.minimum(size[a], size[b]) >= threshold * np.maximum(size[a], size[b]))
        if side is not None:
            ok &= side[a] != side[b]
        pair = np.setdiff1d(np.minimum(a[ok], b[ok]) * n + np.maximum(a[ok], b[ok]), seen)
        seen = np.union1d(seen, pair)
        for x, y in zip((pair // n).tolist(), (pair % n).tolist(), strict=True):
            p, q = find(int(root[x])), find(int(root[y]))
            if p != q and similarity(sets[x], sets[y]) >= threshold:
                parent[max(p, q)] = min(p, q)
                out.append((x, y))
    return np.array(out, dtype=np.int64).reshape(-1, 2)


def near_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The input's rows without those whose class has a row that stays (the one of least id): rows of classes of one pass as they are."""
    name = lambda i: F.concat_ws(":", F.when(i.isNull(), "").otherwise(F.concat(F.lit("k"), i.cast("string"))), "t1", "t2").alias("name")
    verdict = near_classes(docs, key, text, threshold).filter("class_size > 1").groupBy(name(F.col(key))).agg(F.max("kept").alias("kept"), F.count("*").alias("rows"))
    verdict = cut(verdict.filter("not kept or rows > 1"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(key).alias("id"), *_hashes(text_of(text))).select("row", name(F.col("id")))
    out = bloom.without(rows, cut(verdict.filter("not kept").select("name")), "name")
    twins = cut(verdict.filter("kept").select("name"))
    if not twins.isEmpty():  # rows equal in id and text
        once = out.join(twins, "name", "left_semi").groupBy("name").agg(F.first("row").alias("row")).select("row", "name")
        out = bloom.without(out, twins, "name").select("row", "name").unionByName(once)
    return out.select("row.*")
