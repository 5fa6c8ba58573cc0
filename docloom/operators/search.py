"""Keyword search ranked by BM25 over an inverted index, and exact vector search."""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.udf import vectorised

K1, B, LEAST_IDF = 1.2, 0.75, 1e-6
BLOCK_VECTORS = 4096
_TOKEN = regex.compile(r"[\p{L}\p{N}\p{Co}]+")


def fold(text: str) -> str:
    """Lower case without diacritics."""
    return "".join(c for c in unicodedata.normalize("NFD", text.lower()) if not unicodedata.combining(c))


@vectorised("string")
def folded(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else fold(t))


def tokens(text: Column) -> Column:
    """Runs of letters and numbers of a folded text. Texts of ASCII alone are folded without leaving the JVM."""
    own = F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(folded(text))
    return F.regexp_extract_all(own, F.lit(r"([\p{L}\p{N}\p{Co}]+)"), F.lit(1))


def index(documents: DataFrame, key: str, columns: tuple[str, ...]) -> DataFrame:
    """key, token, field, pos: one row per token of the given columns."""
    parts = [documents.select(key, F.lit(i).alias("field"), F.posexplode(tokens(F.coalesce(F.col(c), F.lit("")))).alias("pos", "token")) for i, c in enumerate(columns)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def lengths(postings: DataFrame, key: str) -> DataFrame:
    return postings.groupBy(key).agg(F.count("*").alias("length"))


def phrases(query: str) -> list[list[str]]:
    """The tokens of each blank-separated word; words without a token don't count."""
    found = [_TOKEN.findall(fold(w.replace('"', ""))) for w in query.split()]
    return [p for p in found if p]


def _scored(hits: DataFrame, totals: DataFrame, key: str, n_phrases: int, limit: int | None) -> DataFrame:
    """hits: key, length, phrase and f, its number of places; totals: one row with n (documents) and mean (their length). BM25, lower is better."""
    found = hits.groupBy("phrase").agg(F.count("*").alias("df"))  # as many rows as phrases
    idf = F.log((F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weights = found.crossJoin(F.broadcast(totals)).select("phrase", "mean", F.when(idf > 0, F.greatest(idf, F.lit(LEAST_IDF))).otherwise(LEAST_IDF).alias("idf"))
    part = F.col("idf") * F.col("f") * (K1 + 1) / (F.col("f") + K1 * (1 - B + B * F.col("length") / F.col("mean")))
    every = hits.join(F.broadcast(weights), "phrase").groupBy(key).agg(F.count("*").alias("n"), (-F.sum(part)).alias("score")).filter(F.col("n") == n_phrases)
    every = every.select(key, "score")
    return every if limit is None else every.orderBy("score", key).limit(limit)


def _means(sizes: DataFrame, n_documents: Column) -> DataFrame:
    """One row: documents and their mean length, 1 where there is none."""
    mean = F.sum("length") / n_documents
    return sizes.agg(n_documents.cast("long").alias("n"), F.when(mean > 0, mean).otherwise(1.0).alias("mean"))


def keyword_search(postings: DataFrame, sizes: DataFrame, n_documents: int, key: str, query: str, limit: int | None = 20) -> DataFrame:
    """key and score (lower is better) of the documents that have every phrase of the query, best first, ties by key. Only the postings of the
    query's tokens are read. An empty query finds nothing. Without a limit: all of them, in no order."""
    wanted = phrases(query)
    if not wanted:
        return postings.select(key, F.lit(0.0).alias("score")).limit(0)
    hits = None
    for i, phrase in enumerate(wanted):
        own = postings.filter(F.col("token") == phrase[0]).select(key, "field", F.col("pos").alias("p"))
        for k, token in enumerate(phrase[1:], 1):
            following = postings.filter(F.col("token") == token).select(key, "field", (F.col("pos") - k).alias("p"))
            own = own.join(following, [key, "field", "p"], "left_semi")
        own = own.groupBy(key).agg(F.count("*").alias("f")).withColumn("phrase", F.lit(i))
        hits = own if hits is None else hits.unionByName(own)
    return _scored(hits.join(sizes, key), _means(sizes, F.lit(n_documents)), key, len(wanted), limit)


def scan_search(documents: DataFrame, key: str, columns: tuple[str, ...], query: str, limit: int | None = 20) -> DataFrame:
    """What keyword_search gives, for a query that isn't worth an index: documents are read once for their lengths and once for their hits, and only
    a hit's key, length and counts leave the scan. Keys must be unique."""
    wanted = phrases(query)
    if not wanted:
        return documents.select(key, F.lit(0.0).alias("score")).limit(0)
    fields = [tokens(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in columns]
    read = documents.select(key, F.array(*fields).alias("fields"))
    length = F.aggregate("fields", F.lit(0), lambda n, t: n + F.size(t)).cast("long")

    def places(phrase: list[str]) -> Column:
        at = lambda t, i: F.forall(F.array(*[F.coalesce(F.get(t, i + k) == w, F.lit(False)) for k, w in enumerate(phrase[1:], 1)]), lambda x: x) if phrase[1:] else F.lit(True)
        in_field = lambda t: F.size(F.filter(F.transform(t, lambda w, i: (w == phrase[0]) & at(t, i)), lambda x: x))
        return F.aggregate("fields", F.lit(0), lambda n, t: n + in_field(t)).cast("long")

    counted = read.select(key, length.alias("length"), F.array(*[F.struct(F.lit(i).alias("phrase"), places(p).alias("f")) for i, p in enumerate(wanted)]).alias("hits"))
    hits = counted.select(key, "length", F.inline("hits")).filter("f > 0")
    return _scored(hits, _means(read.select(length.alias("length")), F.count("*")), key, len(wanted), limit)


def store_index(postings: DataFrame, path: str, key: str) -> DataFrame:
    """Writes an index for many searches, in order of token: a search reads the row groups whose bounds hold its tokens. A frequent token's postings
    span as many files as they need."""
    postings.repartitionByRange("token", key).sortWithinPartitions("token", key, "field", "pos").write.mode("overwrite").parquet(path)
    return postings.sparkSession.read.schema(postings.schema).parquet(path)


def snippet(body: str, query: str, size: int = 12) -> str:
    """The window of `size` words with most hits, hits in brackets, and marks where text is left out."""
    spots = [(m.start(), m.end(), fold(m.group())) for m in _TOKEN.finditer(body)]
    wanted = {t for p in phrases(query) for t in p}
    if not spots:
        return body
    hits = [s[2] in wanted for s in spots]
    first = max(range(max(1, len(spots) - size + 1)), key=lambda i: (sum(hits[i : i + size]), -i))
    last = min(len(spots), first + size)
    out, at = [], spots[first][0] if first else 0
    for (a, b, _), hit in zip(spots[first:last], hits[first:last], strict=True):
        out.append(body[at:a] + (f"[{body[a:b]}]" if hit else body[a:b]))
        at = b
    return (" … " if first else "") + "".join(out) + (" … " if last < len(spots) else body[at:])


def snippets(found: DataFrame, body: str, query: str) -> DataFrame:
    @F.pandas_udf("string")
    def run(text: pd.Series) -> pd.Series:
        return text.map(lambda t: snippet(t or "", query))

    return found.withColumn("snippet", run(F.col(body)))


def vector_search(vectors: DataFrame, key: str, vector: str, query: list[float], limit: int = 10) -> DataFrame:
    """Largest dot products first (the cosine for unit vectors), ties by key."""
    q = F.array(*[F.lit(float(x)) for x in query])
    product = F.aggregate(F.zip_with(F.col(vector), q, lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, x: s + x)
    return vectors.select(key, product.alias("score")).orderBy(F.desc("score"), key).limit(limit)


def vector_search_each(vectors: DataFrame, queries: DataFrame, key: str, vector: str, limit: int = 10) -> DataFrame:
    """query, key and score: for each row of queries (its key is the query) what vector_search gives. Blocks of queries are compared with blocks
    of vectors; the best of every pair of blocks meet by query. Rows without a vector are left out; all vectors must have one length."""

    def matrix(column: pa.ChunkedArray) -> np.ndarray:
        if len(pc.unique(pc.list_value_length(column))) > 1:
            raise ValueError("vectors of different lengths")
        return pc.list_flatten(column).to_numpy().astype(np.float64).reshape(len(column), -1)

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.take(pc.sort_indices(right.column("key")))
        parts = []
        if len(left) and len(right):
            q, v = matrix(left.column("vector")), np.ascontiguousarray(matrix(right.column("vector")).T)
            if q.shape[1] != len(v):
                raise ValueError("vectors of different lengths")
            for at in range(0, len(q), 32):
                scores = np.zeros((len(q[at : at + 32]), len(right)))
                for k in range(len(v)):  # summed in order, so that equal vectors have equal scores
                    scores += q[at : at + 32, k, None] * v[k]
                for i, own in enumerate(scores):
                    places = np.flatnonzero(own >= np.partition(own, -limit)[-limit]) if len(own) > limit else np.arange(len(own))
                    places = places[np.argsort(-own[places], kind="stable")][:limit]  # ties by key
                    parts.append((np.full(len(places), at + i), places, own[places]))
        rows, places, scores = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
        return pa.table({"query": left.column("key").take(rows), key: right.column("key").take(places), "score": scores})

    def block(rows: DataFrame) -> tuple[DataFrame, int]:
        rows = rows.filter(F.col(vector).isNotNull()).select(F.col(key).alias("key"), F.col(vector).alias("vector"))
        n = max(1, math.ceil(rows.count() / BLOCK_VECTORS))
        return rows.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(n)).cast("int")), n

    def dealt(rows: DataFrame, own: str, other: str, n: int) -> DataFrame:
        return rows.select(F.col("block").alias(own), F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(other), "key", "vector").groupBy("i", "j")

    (q, n_q), (v, n_v) = block(queries), block(vectors)
    kind = vectors.schema[key].dataType.simpleString()
    found = dealt(q, "i", "j", n_v).cogroup(dealt(v, "j", "i", n_q)).applyInArrow(best, f"query {queries.schema[key].dataType.simpleString()}, {key} {kind}, score double")
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), key))
    return found.withColumn("__place", place).filter(F.col("__place") <= limit).drop("__place")


def unit(vector: list[float]) -> list[float]:
    norm = math.sqrt(sum(x * x for x in vector)) or 1.0
    return [x / norm for x in vector]


def embedded(texts: DataFrame, key: str, text: str, embed: Callable[[list[str]], list[list[float]]], batch: int = 64) -> DataFrame:
    """key, text_hash and the unit vector of each text, by a function that the caller brings."""

    def run(frames):
        for frame in frames:
            for at in range(0, len(frame), batch):
                part = frame.iloc[at : at + batch]
                vectors = [unit(v) for v in embed(part[text].fillna("").tolist())]
                yield pd.DataFrame({key: part[key].to_numpy(), "text_hash": part["text_hash"].to_numpy(), "vector": vectors})

    own = texts.select(key, text, F.sha2(F.col(text).cast("binary"), 256).alias("text_hash"))
    return own.mapInPandas(run, f"{key} {texts.schema[key].dataType.simpleString()}, text_hash string, vector array<double>")


def stale(records: DataFrame, stored: DataFrame, key: str = "record_id", text: str = "search_text") -> DataFrame:
    """Records whose vector is missing or was made from another text: stored has the key and text_hash."""
    own = records.withColumn("text_hash", F.sha2(F.col(text).cast("binary"), 256))
    return own.join(stored.select(key, "text_hash"), [key, "text_hash"], "left_anti")
