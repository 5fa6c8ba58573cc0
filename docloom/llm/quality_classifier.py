"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of a document (FEATURES) are counted with numpy over batches of whole texts. Training takes a bounded sample of labelled
documents (SAMPLE_DOCS): features fall into at most BINS bins at sample quantiles, and each tree of depth DEPTH is grown level by
level from gradient and hessian histograms. The ensemble is flattened into arrays (feature, threshold, value by tree and heap
position), and scoring walks all rows down all trees at once, one gather per level.

Driver: the sample's features, SAMPLE_DOCS rows of numbers.

Defined results: null and empty texts have zero for every statistic and are scored like any other; null labels are not learned from;
with one label only every score is the share of that label, shrunk; repeated rows are scored one by one; a table without rows gives
none; other columns are kept, those with output names replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import text_of
from .quality_rules import STOP_WORDS, SYMBOLS
from .toxicity import labelled_sample, remainder, slices

SAMPLE_DOCS = 20_000
BINS = 64
DEPTH = 4
TREES = 80
RATE = 0.15
RIDGE = 1.0
LEAST_HESSIAN = 2.0

FEATURES = (
    "n_words", "n_chars", "n_lines", "chars_per_word", "long_words", "one_letter_words", "distinct_words", "stop_words", "symbol_words", "symbols_per_char",
    "upper_words", "shouted_words", "digit_words", "punctuated_words", "commonest_word", "repeated_windows", "repeated_lines", "words_per_line", "non_ascii",
)


def shares_repeated(codes: np.ndarray, doc: np.ndarray, n: int, window: int) -> np.ndarray:
    """For each document, the share of its windows of `window` codes that occur in it before or after."""
    out = np.zeros(n)
    if len(codes) < window:
        return out
    mixed = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019)
    last = len(codes) - window + 1
    h = np.zeros(last, np.uint64)
    for k in range(window):
        h = (h ^ mixed[k : k + last]) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
    own = doc[:last] == doc[window - 1 :]
    where = doc[:last][own]
    h = h[own] ^ (where.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    by = np.argsort(h, kind="stable")
    s = h[by]
    same = np.zeros(len(s) + 1, bool)
    same[1:-1] = s[1:] == s[:-1]
    repeated = same[1:] | same[:-1]
    total = np.bincount(where, minlength=n)
    return np.bincount(where[by][repeated], minlength=n) / np.maximum(total, 1)


def features(texts: pa.Array) -> np.ndarray:
    """One row of FEATURES per text; no nulls are expected."""
    n = len(texts)
    split = pc.ascii_split_whitespace(texts)
    words = split.flatten()
    kept = pc.not_equal(words, "")
    before = np.concatenate([[0], np.cumsum(kept.to_numpy(zero_copy_only=False).astype(np.int64))])
    offsets = before[np.asarray(split.offsets)]
    words = words.filter(kept).dictionary_encode()
    codes, distinct = words.indices.to_numpy(zero_copy_only=False).astype(np.int64), words.dictionary
    doc = np.repeat(np.arange(n), np.diff(offsets))
    n_words = np.diff(offsets).astype(np.float64)
    each = np.maximum(n_words, 1)

    def flag(values) -> np.ndarray:
        return np.asarray(values.to_numpy(zero_copy_only=False) if hasattr(values, "to_numpy") else values, dtype=np.float64)

    def total(by_word: np.ndarray) -> np.ndarray:
        return np.bincount(doc, by_word[codes], minlength=n) if len(codes) else np.zeros(n)

    length = flag(pc.utf8_length(distinct))
    symbol = pc.match_substring_regex(distinct, "[" + "".join("\\" + c for c in SYMBOLS) + "]")
    bare = pc.utf8_rtrim(distinct, ".,;:!?")
    letters = pc.match_substring_regex(distinct, r"\p{L}")
    shouted = pc.and_(pc.equal(pc.utf8_upper(distinct), distinct), letters)
    chars = total(length)
    pair = doc * (len(distinct) + 1) + codes
    seen, times = np.unique(pair, return_counts=True)
    owner = seen // (len(distinct) + 1)
    most = np.zeros(n)
    np.maximum.at(most, owner, times)
    lines = pc.split_pattern(texts, "\n")
    parts = lines.flatten()
    full = pc.not_equal(pc.ascii_trim_whitespace(parts), "").to_numpy(zero_copy_only=False)
    line_doc = np.repeat(np.arange(n), np.diff(np.asarray(lines.offsets)))[full]
    line_code = parts.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)[full]
    n_lines = np.bincount(line_doc, minlength=n).astype(np.float64)
    distinct_lines = np.bincount(np.unique(line_doc * (len(parts) + 1) + line_code) // (len(parts) + 1), minlength=n)
    n_chars = flag(pc.utf8_length(texts))
    symbols = total(flag(pc.count_substring_regex(distinct, "[" + "".join("\\" + c for c in SYMBOLS) + "]")))
    columns = [
        n_words, n_chars, n_lines, chars / each, total((length > 12).astype(float)) / each, total((length == 1).astype(float)) / each, np.bincount(owner, minlength=n) / each,
        total(flag(pc.is_in(pc.utf8_lower(bare), pa.array(STOP_WORDS)))) / each, total(flag(symbol)) / each, symbols / np.maximum(n_chars, 1),
        total(flag(pc.match_substring_regex(distinct, r"^\p{Lu}"))) / each, total(flag(shouted) * (length > 1)) / each, total(flag(pc.match_substring_regex(distinct, "[0-9]"))) / each,
        total(flag(pc.match_substring_regex(distinct, r"[.,;:!?]$"))) / each, most / each, shares_repeated(codes, doc, n, 5), (n_lines - distinct_lines) / np.maximum(n_lines, 1),
        n_words / np.maximum(n_lines, 1), (flag(pc.binary_length(texts)) - n_chars) / np.maximum(n_chars, 1),
    ]
    return np.column_stack(columns)


@dataclass(frozen=True)
class Trees:
    """feature and threshold by tree and inner node, value by tree and leaf; node i has children 2i+1 (at or below) and 2i+2."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    start: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        n_trees, inner = self.feature.shape
        node = np.zeros((len(x), n_trees), dtype=np.int64)
        row, tree = np.arange(len(x))[:, None], np.arange(n_trees)[None, :]
        for _ in range(int(np.log2(inner + 1))):
            node = 2 * node + 1 + (x[row, self.feature[tree, node]] > self.threshold[tree, node])
        margin = self.start + self.value[tree, node - inner].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def boost(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS, rate: float = RATE) -> Trees:
    n, m = x.shape
    share = (y.sum() + 0.5) / (n + 1)
    start = float(np.log(share / (1 - share)))
    inner = 2**depth - 1
    if n == 0 or y.min() == y.max():
        return Trees(np.zeros((1, inner), int), np.full((1, inner), np.inf), np.zeros((1, inner + 1)), start)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for j in range(m)]
    binned = np.column_stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)])
    flat = binned + np.arange(m) * bins
    margin = np.full(n, start)
    out = [np.zeros((trees, inner), dtype=np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1))]
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        node = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            count, base = 2**level, 2**level - 1
            place = ((node - base)[:, None] * (m * bins) + flat).ravel()
            shape = (count, m, bins)
            hist_g = np.bincount(place, np.repeat(g, m), minlength=count * m * bins).reshape(shape).cumsum(axis=2)
            hist_h = np.bincount(place, np.repeat(h, m), minlength=count * m * bins).reshape(shape).cumsum(axis=2)
            all_g, all_h = hist_g[:, :, -1:], hist_h[:, :, -1:]
            gain = hist_g**2 / (hist_h + RIDGE) + (all_g - hist_g) ** 2 / (all_h - hist_h + RIDGE) - all_g**2 / (all_h + RIDGE)
            gain[(hist_h < LEAST_HESSIAN) | (all_h - hist_h < LEAST_HESSIAN)] = -np.inf
            best = gain.reshape(count, -1).argmax(axis=1)
            for k, b in enumerate(best.tolist()):
                j, cut_at = divmod(b, bins)
                if gain[k, j, cut_at] > 1e-6 and cut_at < len(edges[j]):
                    out[0][t, base + k], out[1][t, base + k] = j, edges[j][cut_at]
            node = 2 * node + 1 + (x[np.arange(n), out[0][t, node]] > out[1][t, node])
        leaf = node - inner
        sums = np.bincount(leaf, g, minlength=inner + 1), np.bincount(leaf, h, minlength=inner + 1)
        out[2][t] = -rate * sums[0] / (sums[1] + RIDGE)
        margin += out[2][t][leaf]
    return Trees(*out, start)


def train(sample: DataFrame) -> Trees:
    """sample: label (0 or 1) and text, of bounded size."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(list(features(part.column(1))), pa.list_(pa.float64()))], names=["label", "x"])

    rows = sample.select("label", "text").mapInArrow(run, "label int, x array<double>").toArrow()
    y = rows.column("label").to_numpy().astype(np.float64)
    x = np.array(rows.column("x").to_pylist(), dtype=np.float64).reshape(-1, len(FEATURES))
    by = np.lexsort([*x.T, y])  # the order in which rows arrive doesn't matter
    return boost(x[by], y[by])


def score(docs: DataFrame, model: Trees, text: str = "text") -> DataFrame:
    """The input with score and predicted."""
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField("score", T.DoubleType())])

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                x = features(part.column(part.num_columns - 1))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(model.probability(x))], names=schema.names)

    out = docs.select(*kept, text_of(text).alias("__text")).mapInArrow(run, schema)
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", learn: Column | None = None) -> DataFrame:
    """Scores of all rows by a model learned from labels whose key's remainder mod 3 isn't 1; adds held_out."""
    learn = remainder(key, 3) != 1 if learn is None else learn
    model = train(labelled_sample(docs, labels, "quality", learn, key, text, SAMPLE_DOCS))
    return score(docs.withColumn("held_out", F.coalesce(remainder(key, 3) == 1, F.lit(False))), model, text)
