"""Packing token sequences by Karmarkar-Karp multiway differencing.

Documents become ids (a public tokenizer's, then an end id) and are cut at every `capacity` ids; full pieces are sequences of
their own. The remainders of CHUNK_DOCS consecutive documents of a task are dealt into windows together: multiway differencing
keeps one partial partition per remainder and, again and again, merges the two whose windows differ most, largest window of one
with smallest of the other, until one partition into near-equal windows is left. Where a window exceeds the capacity, the window count rises
and the remainders are dealt again. Of the windows found, the fullest are kept, as many as the ids fill; the others are cut to fill their gaps, so
that nothing is padded. What is left, fewer ids than one window holds, joins the next chunk's remainders; at a task's end it becomes sequences whose
lengths are different powers of two, which need no padding: at most twelve short ones a task.

There is no shuffle: a chunk's memory is bounded by CHUNK_DOCS documents or CHUNK_CHARS characters (a longer text is a chunk of its
own), no key gathers rows, and a lost task is run again alone. Sequence ids are the task's number and a count.

Defined results: a null text is an empty one, whose only id is the end id; null ids and repeated rows are documents of their own;
an empty table gives no piece; a very long text is cut like any other; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
import os
import sys
import types
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import give_back
from .wordpieces import MOST_BYTES, PATTERN, WordPieces

CAPACITY = 4096
END_ID = 2
CHUNK_DOCS = 1024
CHUNK_CHARS = 2_000_000
CACHED_WORDS = 200_000


class WordCache:
    """Ids of texts by way of their distinct blank-separated words. Only for tokenizers whose pieces never cross or hold white space and
    whose ids of a word don't depend on its neighbours; the end of a word is where ASCII white space stands. Words of letters with signs
    behind them, nearly all there are, are encoded together by WordPieces; the tokenizer encodes the others, and the signs."""

    def __init__(self, path: str, most: int = CACHED_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer, self.pieces, self.most = Tokenizer.from_file(path), WordPieces(path), most
        self.known: dict[str, np.ndarray] = {}

    def by_tokenizer(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """ids of the words one after another, and each word's number of ids."""
        distinct = words.to_pylist()
        if len(self.known) + len(distinct) > self.most:
            self.known.clear()
        new = [w for w in distinct if w not in self.known]
        for at in range(0, len(new), 20_000):
            part = new[at : at + 20_000]
            for w, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                self.known[w] = np.array(e.ids, dtype=np.uint32)
        each = [self.known[w] for w in distinct]
        return np.concatenate(each) if each else np.zeros(0, np.uint32), np.fromiter(map(len, each), np.int64, len(each))

    def of_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same, for distinct words: most are parted into letters and signs, of which there are fewer kinds."""
        parts = pc.extract_regex(words, PATTERN)
        letters, tail = pc.struct_field(parts, "letters"), pc.struct_field(parts, "tail")
        fits = pc.and_kleene(parts.is_valid(), pc.less_equal(pc.binary_length(words), MOST_BYTES)).fill_null(False).to_numpy(zero_copy_only=False)
        rows = np.flatnonzero(fits)
        lower, signs = (pc.utf8_lower(letters.take(pa.array(rows))).dictionary_encode(), tail.take(pa.array(rows)).dictionary_encode())
        rest = np.flatnonzero(~fits)
        groups = [self.pieces.encode(lower.dictionary), self.by_tokenizer(signs.dictionary), self.by_tokenizer(words.take(pa.array(rest)))]
        flat = np.concatenate([g[0] for g in groups])
        # each word is one or two runs of flat: where they start and how long they are
        starts, lengths, base = [], [], 0
        for ids, n in groups:
            starts.append(base + np.cumsum(n) - n)
            lengths.append(n)
            base += len(ids)
        at, n = np.zeros((len(words), 2), np.int64), np.zeros((len(words), 2), np.int64)
        for k, codes in enumerate((lower.indices, signs.indices)):
            code = codes.to_numpy(zero_copy_only=False).astype(np.int64)
            at[rows, k], n[rows, k] = starts[k][code], lengths[k][code]
        at[rest, 0], n[rest, 0] = starts[2], lengths[2]
        at, n = at.ravel(), n.ravel()
        ids = flat[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(at, n)]
        return ids, n.reshape(-1, 2).sum(axis=1)

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each text's ids end."""
        split = pc.ascii_split_whitespace(texts)
        words = split.flatten().dictionary_encode()
        flat, lengths = self.of_words(words.dictionary)
        starts = np.cumsum(lengths) - lengths
        codes = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        n = lengths[codes]
        ends = np.concatenate([[0], np.cumsum(n)])
        ids = flat[np.arange(ends[-1]) + np.repeat(starts[codes] - ends[:-1], n)] if len(codes) else flat[:0]
        return ids, ends[np.asarray(split.offsets)[1:] - np.asarray(split.offsets)[0]]


def worker_cache(path: str) -> WordCache:
    """One per Python worker: it outlives the task, as functions of this package, which travel by value, don't."""
    state = sys.modules.setdefault("docloom_worker_state", types.ModuleType("docloom_worker_state")).__dict__
    if path not in state:
        state[path] = WordCache(path)
    return state[path]


def differencing(sizes: np.ndarray, windows: int) -> np.ndarray:
    """The window of each item; windows' sums are near one another."""
    n = len(sizes)
    if windows == 1 or n == 0:
        return np.zeros(n, dtype=np.int64)
    empty = np.full(windows, -1, dtype=np.int64)
    heap, left, right = [], [], []
    for i in np.argsort(-sizes, kind="stable"):
        sums, roots = np.zeros(windows, dtype=np.int64), empty.copy()
        sums[0], roots[0] = sizes[i], i
        heap.append((-int(sizes[i]), len(heap), sums, roots))
    heapq.heapify(heap)
    made = n
    while len(heap) > 1:
        _, order, a, ra = heapq.heappop(heap)
        _, _, b, rb = heapq.heappop(heap)
        sums, rb = a + b[::-1], rb[::-1]
        both = np.flatnonzero((ra >= 0) & (rb >= 0))
        roots = np.where(ra >= 0, ra, rb)
        left.append(ra[both])
        right.append(rb[both])
        roots[both] = made + np.arange(len(both))
        made += len(both)
        by = np.argsort(-sums, kind="stable")
        sums, roots = sums[by] - sums[by[-1]], roots[by]
        heapq.heappush(heap, (-int(sums[0]), order, sums, roots))
    window = np.empty(made, dtype=np.int64)
    roots = heap[0][3]
    window[roots[roots >= 0]] = np.flatnonzero(roots >= 0)
    lefts, rights = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right))
    for node in range(made - 1, n - 1, -1):
        window[lefts[node - n]] = window[rights[node - n]] = window[node]
    return window[:n]


def windows_without_cutting(sizes: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """Differencing into windows of which none exceeds the capacity: their number rises, by ever larger steps, as long as one does. No size may
    exceed the capacity."""
    count, step = max(1, -(-int(sizes.sum()) // capacity), int((2 * sizes > capacity).sum())), 1
    while True:
        window = differencing(sizes, count)
        if not len(sizes) or np.bincount(window, sizes, minlength=count).max() <= capacity:
            return window
        count, step = count + step, 2 * step


def pack_windows(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int]], int, list[tuple[int, int, int]]]:
    """Pieces (document, start, length, sequence, offset) of full sequences, their number, and the pieces (document, start, length) that are left: fewer
    than `capacity` ids in all."""
    pieces, sequences = [], 0
    rest: list[tuple[int, int, int]] = []
    for d, n in enumerate(lengths.tolist()):
        for start in range(0, n - capacity + 1, capacity):
            pieces.append((d, start, capacity, sequences, 0))
            sequences += 1
        if n % capacity:
            rest.append((d, n - n % capacity, n % capacity))
    sizes = np.array([r[2] for r in rest], dtype=np.int64)
    full = int(sizes.sum()) // capacity
    if not full:
        return pieces, sequences, rest
    window = windows_without_cutting(sizes, capacity)
    fill = np.bincount(window, sizes).astype(np.int64)
    # the fullest windows stay, as many as can be filled; the others are cut to fill them
    place = {w: i for i, w in enumerate(np.argsort(-fill, kind="stable")[:full].tolist())}
    held, loose = [0] * full, []
    for r, w in zip(rest, window.tolist(), strict=True):
        if w in place:
            k = place[w]
            pieces.append((*r, sequences + k, held[k]))
            held[k] += r[2]
        else:
            loose.append(r)
    left, k = [], 0
    for d, start, n in sorted(loose, key=lambda r: -r[2]):
        while n and k < full:
            take = min(n, capacity - held[k])
            if take:
                pieces.append((d, start, take, sequences + k, held[k]))
                held[k], start, n = held[k] + take, start + take, n - take
            k += held[k] == capacity
        if n:
            left.append((d, start, n))
    return pieces, sequences + full, left


def pack_tail(rest: list[tuple[int, int, int]], sequences: int) -> list[tuple[int, int, int, int, int]]:
    """What is left at a task's end, as sequences whose lengths are different powers of two."""
    pieces, k = [], 0
    rest, total = [list(r) for r in rest], sum(r[2] for r in rest)
    for bit in reversed(range(total.bit_length())):
        need, offset = total & (1 << bit), 0
        while need:
            r = rest[k]
            take = min(need, r[2])
            pieces.append((r[0], r[1], take, sequences, offset))
            need, offset, r[1], r[2] = need - take, offset + take, r[1] + take, r[2] - take
            k += not r[2]
        sequences += bool(total & (1 << bit))
    return pieces


SCHEMA = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece; with_ids adds the ids themselves."""
    kind = docs.schema[key].dataType
    schema = T.StructType([T.StructField(key, kind), *T.StructType.fromDDL(SCHEMA)] + [T.StructField("ids", T.ArrayType(T.IntegerType()))] * with_ids)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, sequences = worker_cache(tokenizer), TaskContext.get().partitionId() << 40
        # what the chunks before have left over: ids of pieces, with their documents' names, starts and lengths
        held: tuple | None = None

        def emitted(pieces, names, ids, first, begin, total) -> pa.RecordBatch:
            doc, start, length, sequence, offset = np.array(pieces, dtype=np.int64).reshape(-1, 5).T
            raw, at = memoryview(ids.astype("<u4").tobytes()), first[doc] + start
            crc = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(at.tolist(), length.tolist(), strict=True)]
            columns = [names.take(pa.array(doc)), begin[doc] + start, length, pa.array(crc, pa.int64()), total[doc], sequence, offset]
            if with_ids:
                columns.append(pa.array([ids[a : a + n].astype(np.int32) for a, n in zip(at.tolist(), length.tolist(), strict=True)], pa.list_(pa.int32())))
            return pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], names=schema.names)

        for names, texts in chunks(batches):
            ids, ends = cache.ids(texts)
            lengths = np.diff(ends, prepend=0) + 1
            ids, begin, total = np.insert(ids, ends, END_ID), np.zeros(len(lengths), np.int64), lengths
            if held is not None:
                names, ids = pa.concat_arrays([held[0], names]), np.concatenate([held[1], ids])
                lengths, begin, total = (np.concatenate(x) for x in zip(held[2:], (lengths, begin, total), strict=True))
            first = np.cumsum(lengths) - lengths
            pieces, n, left = pack_windows(lengths, capacity)
            if pieces:
                yield emitted([(*p[:3], p[3] + sequences, p[4]) for p in pieces], names, ids, first, begin, total)
            sequences += n
            doc, start, size = np.array(left, dtype=np.int64).reshape(-1, 3).T
            own = [ids[a : a + k] for a, k in zip((first[doc] + start).tolist(), size.tolist(), strict=True)]
            held = (names.take(pa.array(doc)), np.concatenate([ids[:0], *own]), size, begin[doc] + start, total[doc])
            give_back()
        if held is not None and len(held[2]):
            names, ids, size, begin, total = held
            tail = pack_tail([(d, 0, n) for d, n in enumerate(size.tolist())], sequences)
            yield emitted(tail, names, ids, np.cumsum(size) - size, begin, total)

    return docs.select(F.col(key), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("__text")).mapInArrow(packed, schema)


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Ids and texts of consecutive documents, at most CHUNK_DOCS and, but for one longer text, CHUNK_CHARS bytes at a time."""
    held: list[tuple[pa.Array, pa.Array]] = []
    rows = size = 0

    def joined():
        return tuple(pa.concat_arrays(x) for x in zip(*held, strict=True))

    for batch in batches:
        names, texts = batch.column(0), batch.column(1)
        bytes_ = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        first = 0
        for i, n in enumerate(bytes_.tolist()):
            if rows and (rows == CHUNK_DOCS or size + n > CHUNK_CHARS):
                if i > first:
                    held.append((names.slice(first, i - first), texts.slice(first, i - first)))
                yield joined()
                held, rows, size, first = [], 0, 0, i
            rows, size = rows + 1, size + n
        if len(bytes_) > first:
            held.append((names.slice(first), texts.slice(first)))
    if held:
        yield joined()
