"""Toxicity by maximum-scoring segments.

Training counts in how many documents a token stands, in a bounded sample of labelled documents (SAMPLE_DOCS; one of each group with the same text or the same least five-word
shingle hash, so that copies count once): a token's score is the log-odds of its rate in toxic against other documents, shrunk by
a Dirichlet prior proportional to its rate in both. Beside the token itself its first 3 to 6 characters are counted ("chll*"), which
catches inflected and compounded forms; the longest unit of a token that has a score gives it. Units whose log-odds are within Z_LEAST standard errors or ODDS_LEAST of zero score nothing,
and every token pays DRIFT, so that the expected score of clean text is negative.

Scoring, over all rows: one pass over the token scores finds every maximal-scoring segment of a text (Ruzzo and Tompa's linear-time
scan; only tokens that score above zero can open a segment, the others are gaps summed up between them). A segment's normalised
score is lambda * S - ln(K * n), n the text's tokens, with Karlin and Altschul's lambda solved from the clean token distribution and
K estimated on clean training texts. Segments above zero are significant passages; a document's evidence is the sum of their
normalised scores, and a logistic curve fitted on the training sample turns it and the best segment's score into a probability.

Driver: the scores of the units that pass these limits in the bounded sample, and two numbers and a label for each sampled document.

Defined results: null and empty texts have no tokens and no segment, and get the curve's value at zero evidence; null labels are not
learned from; a document with several labels counts with each; without toxic or without clean labels every score is the prior share;
repeated rows are scored one by one; a table without rows gives none; other columns are kept, those with output names replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, give_back, let, text_of, words_of

SAMPLE_DOCS = 20_000
LEAST_COUNT = 5
PRIOR_SHARE = 0.1
Z_LEAST = 3.4
ODDS_LEAST = 2.0
DRIFT = 0.05
SLICE_BYTES = 3_000_000
PREFIXES = (6, 5, 4, 3)
#: Characters stripped from both ends of a word to make a token.
EDGES = ".,;:!?\"'()[]{}<>*#$%&|_-+=/\\~`^@«»“”‘’…–—"


@dataclass(frozen=True)
class Model:
    """Token scores without the drift, and the constants of the calibration."""

    scores: dict[str, float]
    drift: float = DRIFT
    scale: float = 1.0  # lambda
    k: float = 1.0
    curve: tuple[float, float, float] = (0.0, 0.0, 0.0)  # constant, per ln(1 + evidence), per best segment
    least: float = 0.0  # normalised score above which a segment counts

    def probability(self, evidence: np.ndarray, best: np.ndarray) -> np.ndarray:
        a, b, c = self.curve
        return 1 / (1 + np.exp(-np.clip(a + b * np.log1p(evidence) + c * np.log1p(best), -30, 30)))


def tokens_of(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Tokens of all texts (words, lower-cased, stripped of EDGES), and the first token's place of each text with the total at the end."""
    split = pc.ascii_split_whitespace(texts)
    words = split.flatten()
    kept = pc.not_equal(words, "")
    before = np.concatenate([[0], np.cumsum(kept.to_numpy(zero_copy_only=False).astype(np.int64))])
    words = words.filter(kept).dictionary_encode()
    offsets = before[np.asarray(split.offsets)]
    return pa.DictionaryArray.from_arrays(words.indices, pc.utf8_trim(pc.utf8_lower(words.dictionary), EDGES)), offsets


def units_of(tokens: pa.Array) -> list[pa.Array]:
    """The tokens, then their prefixes from the longest, null where a token is shorter."""
    length = pc.utf8_length(tokens)
    out = [tokens]
    for n in PREFIXES:
        prefix = pc.binary_join_element_wise(pc.utf8_slice_codeunits(tokens, 0, n), "*", "")
        out.append(pc.if_else(pc.greater_equal(length, n), prefix, None))
    return out


def maximal_segments(places: np.ndarray, scores: np.ndarray, drift: float) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first, last, score) of one text whose positive tokens stand at `places`; a token between two of
    them costs `drift`, and `scores` are already net of it. Tokens of other negative scores come with their own entry."""
    # candidates: first, last, sum before, sum through, and the nearest earlier candidate with a smaller sum before (all between can be skipped)
    stack: list[tuple[int, int, float, float, int]] = []
    total, previous = 0.0, -1
    for place, score in zip(places, scores, strict=True):
        total -= drift * (place - previous - 1)
        previous = place
        if score <= 0:
            total += score
            continue
        first, left, right = place, total, total + score
        total = right
        j = len(stack) - 1
        while True:
            while j >= 0 and stack[j][2] >= left:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= right:
                stack.append((first, place, left, right, j))
                break
            first, _, left, _, before = stack[j]
            del stack[j:]
            j = before
    return [(a, b, right - left) for a, b, left, right, _ in stack]


def segments_of(texts: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number, first token, last token and normalised score of all segments, and every text's token count."""
    tokens, offsets = tokens_of(texts)
    names = pa.array(list(model.scores), pa.string())
    values = np.append(np.fromiter(model.scores.values(), np.float64, len(model.scores)), 0.0)
    found = pc.coalesce(*(pc.index_in(u, names, skip_nulls=True) for u in units_of(tokens.dictionary)))
    by_word = values[found.fill_null(len(model.scores)).to_numpy(zero_copy_only=False)]
    codes = tokens.indices.to_numpy(zero_copy_only=False)
    places = np.flatnonzero((by_word != 0)[codes]) if len(codes) else np.zeros(0, np.int64)
    scores = by_word[codes[places]] - model.drift
    doc = np.searchsorted(offsets, places, side="right") - 1
    n = np.diff(offsets)
    rows = []
    with_positive = np.unique(doc[scores > 0])
    starts, ends = np.searchsorted(doc, with_positive, "left"), np.searchsorted(doc, with_positive, "right")
    for d, a, b in zip(with_positive.tolist(), starts.tolist(), ends.tolist(), strict=True):
        here = (places[a:b] - offsets[d]).tolist()
        base = math.log(max(model.k * float(n[d]), 1e-300))
        rows += [(d, x, y, model.scale * s - base) for x, y, s in maximal_segments(here, scores[a:b].tolist(), model.drift)]
    d, x, y, s = (np.array(c) for c in zip(*rows, strict=True)) if rows else (np.zeros(0), np.zeros(0), np.zeros(0), np.zeros(0))
    return d.astype(np.int64), x.astype(np.int64), y.astype(np.int64), s.astype(np.float64), n


def evidence_of(texts: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sum and maximum of the significant segments' normalised scores, their number, and the token count."""
    d, _, _, s, n = segments_of(texts, model)
    s = np.maximum(0.0, s - model.least)
    best = np.zeros(len(n))
    np.maximum.at(best, d, s)
    return np.bincount(d, s, minlength=len(n)).astype(np.float64), best, np.bincount(d, s > 0, minlength=len(n)).astype(np.int64), n


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose last column holds at most SLICE_BYTES, or one longer text."""
    sizes = pc.binary_length(batch.column(batch.num_columns - 1)).fill_null(0).to_numpy(zero_copy_only=False)
    first, held = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if held and held + n > SLICE_BYTES:
            yield batch.slice(first, i - first)
            first, held = i, 0
        held += n + 1
    if first < batch.num_rows:
        yield batch.slice(first)
    give_back()


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, key: str, text: str, most: int = SAMPLE_DOCS) -> DataFrame:
    """label and text of at most `most` labelled rows that `learn` (a condition on the key) lets in, by hash of the key; of documents with
    the same text or the same least shingle hash one stays. Written to the checkpoint folder."""
    chosen = labels.filter(learn & F.col(key).isNotNull() & F.col(label).isin(0, 1)).select(F.col(key).alias("__id"), F.col(label).cast("int").alias("label"))
    chosen = chosen.distinct().orderBy(F.xxhash64("__id"), "__id", "label").limit(most)
    own = docs.select(F.col(key).alias("__id"), text_of(text).alias("text")).join(F.broadcast(chosen), "__id")
    least = let(words_of(F.col("text")), lambda w: F.array_min(F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - 5, F.lit(0))), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(5)]))))
    once = own.groupBy(least.alias("h"), "label").agg(F.min(F.struct("__id", "text")).alias("one"))
    return cut(once.select("label", "one.text"))


def train(sample: DataFrame) -> Model:
    """sample: label (0 or 1) and text, of bounded size."""

    def count(batches):
        for batch in batches:
            for part in slices(batch):
                tokens, offsets = tokens_of(part.column(1))
                label = part.column(0).to_numpy(zero_copy_only=False)
                doc = np.repeat(np.arange(part.num_rows), np.diff(offsets))
                for unit in units_of(tokens.dictionary):  # in how many documents of either kind it stands
                    unit = unit.dictionary_encode()
                    codes = unit.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)[tokens.indices.to_numpy(zero_copy_only=False)]
                    size = len(unit.dictionary)
                    pairs = np.unique(doc[codes >= 0] * size + codes[codes >= 0])
                    toxic = label[pairs // size] == 1 if size else pairs
                    numbers = [pa.array(np.bincount(pairs % size, w, minlength=size).astype(np.int64)) if size else pa.array([], pa.int64()) for w in (toxic, 1 - toxic)]
                    yield pa.RecordBatch.from_arrays([unit.dictionary, *numbers], names=["token", "toxic", "clean"])

    counts = sample.select("label", "text").mapInArrow(count, "token string, toxic long, clean long").groupBy("token").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    counts = cut(counts)
    n1, n0 = counts.filter(~F.col("token").endswith("*")).agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.coalesce(F.sum("clean"), F.lit(0))).first()
    shares = {r.label: r.n for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    prior = (shares.get(1, 0) + 0.5) / (sum(shares.values()) + 1)
    nothing = Model({}, curve=(math.log(prior / (1 - prior)), 0.0, 0.0))
    if not n1 or not n0:
        return nothing
    prior_tokens = PRIOR_SHARE * (n1 + n0)
    alpha = (F.col("toxic") + F.col("clean")) * PRIOR_SHARE
    odds = lambda y, n: F.log((F.col(y) + alpha) / (n + prior_tokens - F.col(y) - alpha))
    scored = counts.filter((F.col("toxic") + F.col("clean") >= LEAST_COUNT) & (F.col("token") != "")).withColumn("odds", odds("toxic", n1) - odds("clean", n0))
    scored = scored.withColumn("z", F.col("odds") / F.sqrt(1 / (F.col("toxic") + alpha) + 1 / (F.col("clean") + alpha))).filter((F.abs("z") >= Z_LEAST) & (F.abs("odds") >= ODDS_LEAST))
    rows = scored.collect()  # no more than the bounded sample has
    scores = {r.token: float(r.odds) for r in sorted(rows, key=lambda r: r.token)}
    if not any(x > DRIFT for x in scores.values()):
        return nothing
    share = {r.token: (r.clean + (r.toxic + r.clean) * PRIOR_SHARE) / (n0 + prior_tokens) for r in rows}
    values = np.array([scores[t] - DRIFT for t in share])
    p = np.array(list(share.values()))
    model = Model(scores, scale=karlin_lambda(values, p, -DRIFT))
    # a clean text of n tokens has K * n * exp(-x) segments with lambda * S >= x: at x = ln(n), K of them
    shown = statistics(sample, model)
    clean = shown[shown[:, 0] == 0]
    model = Model(scores, scale=model.scale, k=(clean[:, 3].sum() + 0.5) / max(len(clean), 1))
    shown = statistics(sample, model)
    return Model(scores, scale=model.scale, k=model.k, curve=logistic(np.column_stack([np.log1p(shown[:, 1]), np.log1p(shown[:, 2])]), shown[:, 0]))


def karlin_lambda(values: np.ndarray, p: np.ndarray, other: float) -> float:
    """The positive root of sum p * exp(lambda * s) = 1; tokens not listed score `other`."""
    rest = max(1e-9, 1 - p.sum())
    f = lambda x: (p * np.exp(np.minimum(x * values, 700))).sum() + rest * math.exp(x * other) - 1
    low, high = 1e-6, 1.0
    if f(low) >= 0:  # the mean isn't negative: take the raw scores
        return 1.0
    while f(high) < 0 and high < 64:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if f(middle) < 0 else (low, middle)
    return low


def statistics(sample: DataFrame, model: Model) -> np.ndarray:
    """label, evidence, best segment, number of significant segments and tokens of each sampled document."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                total, best, n, tokens = evidence_of(part.column(1), model)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(total), pa.array(best), pa.array(n), pa.array(tokens)], names=["label", "e", "b", "n", "t"])

    rows = sample.select("label", "text").mapInArrow(run, "label int, e double, b double, n long, t long").collect()
    return np.array([tuple(r) for r in rows], dtype=np.float64).reshape(-1, 5)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, ...]:
    """Newton's method, slopes kept at zero or above by dropping a negative one."""
    x1 = np.column_stack([np.ones(len(x)), x])
    free = list(range(x1.shape[1]))
    while True:
        w = np.zeros(x1.shape[1])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x1[:, free] @ w[free], -30, 30)))
            h = (x1[:, free] * (p * (1 - p))[:, None]).T @ x1[:, free] + ridge * np.eye(len(free))
            step = np.linalg.solve(h, x1[:, free].T @ (y - p) - ridge * w[free])
            w[free] += step
            if np.abs(step).max() < 1e-8:
                break
        worst = min(free[1:], key=lambda j: w[j], default=None)
        if worst is None or w[worst] >= 0:
            return tuple(float(v) for v in w)
        free.remove(worst)


OUTPUT = "score double, evidence double, best_segment double, n_passages long, n_tokens long"


def score(docs: DataFrame, model: Model, text: str = "text", passages: bool = False) -> DataFrame:
    """The input with score, predicted, evidence, best_segment, n_passages and n_tokens; with passages, also each significant
    segment's first and last token and normalised score."""
    extra = T.StructField("passages", T.ArrayType(T.StructType.fromDDL("first long, last long, score double")))
    kept = [c for c in docs.columns if c not in {"score", "predicted", "evidence", "best_segment", "n_passages", "n_tokens"} | ({"passages"} if passages else set())]
    schema = T.StructType([docs.schema[c] for c in kept] + T.StructType.fromDDL(OUTPUT).fields + [extra] * passages)

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                texts = part.column(part.num_columns - 1)
                total, best, n, tokens = evidence_of(texts, model)
                columns = [*part.columns[:-1], *map(pa.array, (model.probability(total, best), total, best, n, tokens))]
                if passages:
                    d, x, y, s, _ = segments_of(texts, model)
                    rows: list[list] = [[] for _ in range(part.num_rows)]
                    for i, a, b, v in zip(d.tolist(), x.tolist(), y.tolist(), s.tolist(), strict=True):
                        if v > model.least:
                            rows[i].append({"first": a, "last": b, "score": v})
                    columns.append(pa.array(rows, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("score", pa.float64())]))))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    out = docs.select(*kept, text_of(text).alias("__text")).mapInArrow(run, schema)
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def remainder(key: str, n: int) -> Column:
    """crc32 of the key as text, mod n; null for a null key."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % n


def toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", passages: bool = False) -> DataFrame:
    """Scores of all rows by a model learned from labels whose key's remainder mod 5 isn't 0; adds held_out."""
    model = train(labelled_sample(docs, labels, "toxic", remainder(key, 5) != 0, key, text))
    return score(docs.withColumn("held_out", F.coalesce(remainder(key, 5) == 0, F.lit(False))), model, text, passages)
