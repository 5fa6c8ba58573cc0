"""Repeated substrings by prefix doubling: every byte covered by a WIDTH-byte string that also starts anywhere else is removed.

A position's rank at length 2h is formed from the pair of ranks at the position and h bytes on, for h = 1, 2, 4 .. 64; the last step
to 200 bytes joins the ranks of four overlapping 64-byte strings. Ranks are 64-bit fingerprints of the pair, so that pairs are formed
where the text lies, and what Spark sorts and counts are ranks, never text. Positions leave as soon as they must be unique:

1. In each 200-byte string one 64-byte string inside is its anchor (the one of least rank, the first of several). Equal strings have
   equal anchors at the same place, so runs of positions with one anchor are handled as one. Runs are counted by the anchor's rank;
   an anchor that occurs once ends its run.
2. Runs are counted by anchor and by the rank of all bytes their strings touch. Where that pair occurs twice the whole run repeats; the runs of a
   pair that many share are dealt out in parts.
3. Runs whose anchor repeats but not the bytes around it, the edges of a repeat, bring those bytes (at most 336) together by anchor,
   where their positions are ranked at 200 bytes. Of an anchor with more than MOST_CONTEXTS different surroundings the ranked positions
   themselves are counted by Spark, which no group size can overload.

A Bloom filter of the pairs that matter keeps what leaves the text scans small; it is a prefilter, and what passes is joined exactly. Filters of
anchors and of documents go to all tasks up to 64 MiB; a larger one of anchors is dealt out by slice, one of documents isn't used.
Two different strings are taken for equal only if their 64-bit ranks agree next to an equal anchor rank (about 2^-128 a pair).
Texts are cut in no way: a long one is ranked in pieces of PIECE positions that overlap. The texts themselves are shuffled once, to
meet their removed spans, and only those that a filter of the documents with spans lets through.

Defined results: a null text counts as empty; texts below 200 bytes lose nothing; rows equal in id and text are documents of their own
that repeat each other; null ids are kept; an empty table gives none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import bloom
from .common import BROADCAST_ROWS, HOT_KEYS, HOT_ROWS, cut, discard, saved, text_of

WIDTH = 200
GRAM = 64
PIECE = 1 << 19
MOST_CONTEXTS = 4096
PLACE_BITS = 24

#: Odd multipliers of the fingerprint: fixed values.
_C = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The rank of a pair of ranks."""
    x = a * _C[0]
    x += b * _C[1]
    x ^= x >> np.uint64(32)
    x *= _C[2]
    x ^= x >> np.uint64(29)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64), np.arange(256, dtype=np.uint64) * _C[2])


def grams(data: np.ndarray) -> np.ndarray:
    """The rank at 64 bytes of every position that has as many."""
    x, h = _BYTE[data], 1
    while h < GRAM:
        x, h = mix(x[:-h], x[h:]), 2 * h
    return x


def wide(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The rank at 200 bytes of the positions `at`, from the ranks at 64."""
    return mix(mix(x[at], x[at + GRAM]), mix(x[at + 2 * GRAM], x[at + WIDTH - GRAM]))


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of an array of strings or binaries without nulls, and each one's start with the total at the end."""
    large = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64 if large else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    held = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data is not None and len(at) else np.zeros(0, np.uint8)
    return held, at - at[0]


def runs(data: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """For pieces of the bytes of several texts: text number, first and last position (in data), anchor, the anchor's rank and the rank of
    all bytes touched, of each run of positions whose 200-byte strings have one anchor."""
    for first in range(0, len(data) - WIDTH + 1, PIECE):
        last = min(first + PIECE, len(data) - WIDTH + 1)
        x = grams(data[first : last + WIDTH - 1])
        n = last - first
        place = np.arange(len(x), dtype=np.uint64)
        z, w = (x & ~np.uint64((1 << PLACE_BITS) - 1)) | place, 1
        while 2 * w <= WIDTH - GRAM + 1:
            z, w = np.minimum(z[:-w], z[w:]), 2 * w
        more = WIDTH - GRAM + 1 - w
        anchor = (np.minimum(z[:n], z[more : more + n]) & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
        inside = starts[(starts > first) & (starts < last)] - first
        over = starts[1:] - WIDTH + 1 - first
        over = over[(over > 0) & (over < n)]
        lo = np.unique(np.concatenate([[0], np.flatnonzero(np.diff(anchor)) + 1, inside, over]))
        hi = np.append(lo[1:], n) - 1
        doc = np.searchsorted(starts, lo + first, side="right") - 1
        fits = lo + first + WIDTH <= starts[doc + 1]
        lo, hi, doc = lo[fits], hi[fits], doc[fits]
        a, end = anchor[lo], hi + WIDTH - GRAM
        around = x[lo]
        for k in range(GRAM, 2 * WIDTH - GRAM, GRAM):
            around = mix(around, x[np.minimum(lo + k, end)])
        around = mix(around, ((a - lo) * 1024 + hi - lo).astype(np.uint64))
        yield doc, lo + first, hi + first, a + first, x[a], around


def pair_hash(key: np.ndarray, around: np.ndarray) -> np.ndarray:
    return mix(key, around)


def repeated_in(key: np.ndarray, anchor: np.ndarray, contexts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first and last position of the maximal runs of positions whose strings occur in two rows of the same key. A row's
    positions count from its context's start; anchor is the anchor's place there."""
    row, at, name = names_of(key, anchor, contexts)
    _, inverse, times = np.unique(name, return_inverse=True, return_counts=True)
    twice = times[inverse] > 1
    return spans(row[twice], at[twice])


def names_of(key: np.ndarray, anchor: np.ndarray, contexts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, position and name (rank at 200 bytes with the anchor's key and place) of all positions of all rows."""
    data, starts = raw(contexts)
    if not len(data):
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    x = grams(data)
    count = np.diff(starts) - WIDTH + 1
    row = np.repeat(np.arange(len(count)), count)
    at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    name = mix(wide(x, starts[row] + at), key[row])
    return row, at, mix(name, (anchor[row] - at).astype(np.uint64))


def spans(row: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of consecutive positions, in rows in order."""
    if not len(row):
        return (np.zeros(0, np.int64),) * 3
    new = np.concatenate([[True], (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1)])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(row)) - 1
    return row[first], at[first], at[last]


def removed(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[int, int, np.ndarray]:
    """Bytes removed, maximal runs of them, and the bytes kept, when strings start at first..last of each span."""
    edge = np.zeros(len(data) + 1, dtype=np.int64)
    np.add.at(edge, first, 1)
    np.add.at(edge, last + WIDTH, -1)
    gone = np.cumsum(edge[:-1]) > 0
    n_spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(gone) else 0
    return int(gone.sum()), n_spans, data[~gone]


SPAN = "r1 long, r2 long, first int, last int"


def repeated_spans(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """docs: r1, r2 (a row's key), text. Rows (r1, r2, first, last): all 200-byte strings that start there occur again elsewhere. Also the paths of
    the tables that they are read from, for discard()."""

    def scanned(schema: str, emit):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                data, starts = raw(batch.column(2))
                for doc, lo, hi, a, key, around in runs(data, starts):
                    yield from emit(batch, data, starts, doc, lo, hi, a, key, around)

        return docs.select("r1", "r2", "text").mapInArrow(run, schema)

    def as_batch(schema: str, *columns) -> pa.RecordBatch:
        arrays = [c.view(np.int64) if isinstance(c, np.ndarray) and c.dtype == np.uint64 else c for c in columns]
        return pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in arrays], names=[c.split()[0] for c in schema.split(", ")])

    pair = "key long, around long"

    def emit_pairs(batch, data, starts, doc, lo, hi, a, key, around):
        yield as_batch(pair, key, around)

    by_pair = scanned(pair, emit_pairs).groupBy("key", "around").agg(F.count("*").alias("n"))
    by_pair, path = saved(by_pair)
    by_key = by_pair.groupBy("key").agg(F.sum("n").alias("total"), F.sum(F.when(F.col("n") == 1, 1).otherwise(0)).alias("edges"), F.count("*").alias("contexts")).filter("total > 1")
    by_key = cut(by_key.withColumn("h", F.xxhash64("key")))
    likely = bloom.probed(by_pair.withColumn("h", F.xxhash64("key")), "h", *bloom.sent(by_key, "h", by_key.count())).filter("maybe")
    # every pair whose anchor repeats; `alike` pairs repeat as a whole, the others are edges
    alive = cut(likely.select("key", "around", "n").join(by_key.drop("h"), "key").selectExpr("key", "around", "n", "n > 1 as alike", "edges > 0 as mixed", "contexts"))
    discard(docs.sparkSession, path)

    hashed = alive.withColumn("h", _pair_hash_column("key", "around"))
    alike, mixed = hashed.filter("alike"), hashed.filter("mixed")
    total = lambda x: F.coalesce(F.sum(x), F.lit(0))
    n_alike, n_mixed, n_runs = alive.agg(total(F.col("alike").cast("int")), total(F.col("mixed").cast("int")), total(F.when(F.col("alike"), F.col("n")))).first()

    # runs that repeat as a whole
    place = SPAN + ", " + pair
    wanted = bloom.Bits(alike, "h", n_alike)

    def emit_runs(batch, data, starts, doc, lo, hi, a, key, around):
        ok = np.flatnonzero(wanted.has(spark_pair_hash(key, around)))
        doc, lo, hi = doc[ok], lo[ok] - starts[doc[ok]], hi[ok] - starts[doc[ok]]
        at = pa.array(doc)
        yield as_batch(place, batch.column(0).take(at), batch.column(1).take(at), lo.astype(np.int32), hi.astype(np.int32), key[ok], around[ok])

    # a pair with many runs is dealt out in parts; there can't be more than HOT_KEYS such pairs
    most = max(HOT_ROWS, n_runs // HOT_KEYS)
    parts = alike.select("key", "around", F.ceil(F.col("n") / most).cast("int").alias("parts"))
    hot = F.broadcast(parts.filter("parts > 1"))
    part = F.pmod(F.xxhash64("r1", "r2", "first"), F.coalesce("parts", F.lit(1))).cast("int").alias("part")
    dealt = scanned(place, emit_runs).join(hot, ["key", "around"], "left").select("r1", "r2", "first", "last", "key", "around", part)
    whole = dealt.join(parts.select("key", "around", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")), ["key", "around", "part"]).select("r1", "r2", "first", "last")

    # edges: the bytes around anchors that have at least one
    context = "r1 long, r2 long, base int, anchor int, key long, around long, bytes binary"
    edge = bloom.Bits(mixed, "h", n_mixed)

    def emit_contexts(batch, data, starts, doc, lo, hi, a, key, around):
        ok = np.flatnonzero(edge.has(spark_pair_hash(key, around)))
        once = np.unique(around[ok] ^ key[ok], return_index=True)[1]  # equal surroundings in one piece need to come once only
        ok = ok[np.sort(once)]
        doc, at = doc[ok], pa.array(doc[ok])
        held = pa.array([data[x : y + WIDTH].tobytes() for x, y in zip(lo[ok].tolist(), hi[ok].tolist(), strict=True)], pa.binary())
        yield as_batch(context, batch.column(0).take(at), batch.column(1).take(at), (lo[ok] - starts[doc]).astype(np.int32), (a[ok] - lo[ok]).astype(np.int32), key[ok], around[ok], held)

    # of each pair one context is enough: the others are equal to it and known to repeat
    contexts = scanned(context, emit_contexts).groupBy("key", "around").agg(F.min(F.struct("r1", "r2", "base", "anchor", "bytes")).alias("one")).select("key", "one.*")
    large = cut(alive.filter(F.col("mixed") & (F.col("contexts") > MOST_CONTEXTS)).select("key").distinct())
    n_large, paths = large.count(), []
    if n_large:  # read three times
        contexts, path = saved(contexts)
        paths.append(path)
        # large keys stay where they are: dealt out, each would be in one place
        large = F.broadcast(large) if n_large <= BROADCAST_ROWS else large
    small = contexts.join(large, "key", "left_anti") if n_large else contexts

    def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:  # sorted by key: all but the last key's rows are complete
            table = pa.Table.from_batches([*held, batch]).combine_chunks()
            key = table.column("key").to_numpy()
            done = int(np.searchsorted(key, key[-1], side="left")) if len(key) else 0
            yield from edges_of(table.slice(0, done))
            held = table.slice(done).to_batches()
        if held:
            yield from edges_of(pa.Table.from_batches(held).combine_chunks())

    def edges_of(table: pa.Table) -> Iterator[pa.RecordBatch]:
        for first in range(0, table.num_rows, 8192) if table.num_rows else ():
            key = table.column("key").to_numpy()
            # parts end where a key ends
            start = int(np.searchsorted(key, key[first], side="right")) if first and key[first] == key[first - 1] else first
            stop = min(first + 8192, table.num_rows)
            stop = int(np.searchsorted(key, key[stop - 1], side="right"))
            if start >= stop:
                continue
            part = table.slice(start, stop - start).combine_chunks()
            bytes_ = part.column("bytes").chunk(0)
            row, lo, hi = repeated_in(part.column("key").to_numpy().view(np.uint64), part.column("anchor").to_numpy().astype(np.int64), bytes_)
            base = part.column("base").to_numpy()
            at = pa.array(row)
            yield as_batch(SPAN, part.column("r1").chunk(0).take(at), part.column("r2").chunk(0).take(at), (lo + base[row]).astype(np.int32), (hi + base[row]).astype(np.int32))

    found = small.repartition("key").sortWithinPartitions("key").mapInArrow(matched, SPAN)
    out = whole.unionByName(found)
    if n_large:
        named = "r1 long, r2 long, at int, key long, name long"

        def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for first in range(0, batch.num_rows, 8192):
                    part = pa.RecordBatch.from_arrays([pa.concat_arrays([c.slice(first, 8192)]) for c in batch.columns], names=batch.schema.names)
                    key = part.column("key").to_numpy().view(np.uint64)
                    row, at, name = names_of(key, part.column("anchor").to_numpy().astype(np.int64), part.column("bytes"))
                    where = pa.array(row)
                    yield as_batch(named, part.column("r1").take(where), part.column("r2").take(where), (at + part.column("base").to_numpy()[row]).astype(np.int32), key[row], name)

        many = contexts.join(large, "key", "left_semi")
        names = many.select("r1", "r2", "base", "anchor", "key", "bytes").mapInArrow(explode, named)
        twice = cut(names.groupBy("key", "name").count().filter("count > 1").select("key", "name"))
        out = out.unionByName(names.join(twice, ["key", "name"]).select("r1", "r2", F.col("at").alias("first"), F.col("at").alias("last")))
    return out, paths


def _pair_hash_column(key: str, around: str):
    """A 64-bit value that numpy can compute as well: see spark_pair_hash. Spark's long arithmetic isn't used for products, which ANSI mode checks."""
    return F.col(key).bitwiseXOR(F.shiftleft(F.col(around), 1)).bitwiseXOR(F.shiftrightunsigned(F.col(around), 7))


def spark_pair_hash(key: np.ndarray, around: np.ndarray) -> np.ndarray:
    return key ^ (around << np.uint64(1)) ^ (around >> np.uint64(7))


def suffix_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", with_bytes: bool = False) -> DataFrame:
    """Per row: key, n_bytes, n_removed, n_spans, kept_sha256 and, with_bytes, the bytes that stay."""
    t = text_of(text)
    rows = docs.select(F.col(key), F.xxhash64(F.col(key), t).alias("r1"), F.xxhash64(F.lit("row"), t).alias("r2"), t.alias("text"))
    found, paths = repeated_spans(rows.select("r1", "r2", "text"))
    found = cut(found.groupBy("r1", "r2").agg(F.collect_list("first").alias("first"), F.collect_list("last").alias("last")))
    for path in paths:
        discard(docs.sparkSession, path)
    n = found.count()
    # where the filter is too large to be sent, all texts meet their spans, which deals them out once as well
    marked = bloom.probed(rows, "r1", *bloom.sent(found, "r1", n)) if bloom.fits(n) else rows.withColumn("maybe", F.lit(True))
    kept = "n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept_bytes binary" * with_bytes
    schema = T.StructType([docs.schema[key], *T.StructType.fromDDL(kept)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = raw(batch.column(1))
            out: list[tuple] = []
            for i in range(batch.num_rows):
                own = data[starts[i] : starts[i + 1]]
                first, last = (np.asarray(c[i].values, dtype=np.int64) if c[i].is_valid else np.zeros(0, np.int64) for c in batch.columns[2:4])
                gone, n_spans, rest = removed(own, first, last)
                out.append((len(own), gone, n_spans, hashlib.sha256(rest.tobytes()).hexdigest(), *([rest.tobytes()] if with_bytes else ())))
            types = [pa.int64()] * 3 + [pa.string()] + [pa.binary()] * with_bytes
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([o[k] for o in out], kind) for k, kind in enumerate(types))], names=schema.names)

    joined = marked.filter("maybe").join(found, ["r1", "r2"], "left").select(key, "text", "first", "last").mapInArrow(run, schema)
    binary = F.col("text").cast("binary")
    zero = F.lit(0).cast("long")
    as_is = [F.octet_length("text").cast("long").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"), F.sha2(binary, 256).alias("kept_sha256")]
    return joined.unionByName(marked.filter("not maybe").select(key, *as_is, *([binary.alias("kept_bytes")] if with_bytes else [])))
