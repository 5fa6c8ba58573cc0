"""Exact deduplication by two-pass Bloom filtering, in JVM expressions only.

Pass one sets, for the hash of every text, two bits inside one 32768-bit slice of a filter of 16 bits a row or more, and keeps
the bits that at least two rows have set. Pass two looks each row up in its slice: a row with a bit that no other row has set is
unique and passes straight through; only the others shuffle and are compared by SHA-256. A false hit costs a shuffle of that
row and nothing else, so the result is exact for any filter size. The filter is joined on its slice number: Spark broadcasts it
while it is below spark.sql.autoBroadcastJoinThreshold and else deals both sides out by slice.

Texts are read once, to hash them; what is written to the checkpoint folder, filtered and joined are ids and hashes. The rows of
a group are counted before they are dealt out, so a group of any size is summed up by all tasks. exact_dedup() reads the texts a second
time and deals none of them out, but for rows equal in id and text and, beyond the broadcast's bound, for rows that are likely to go.

Pass one deals out a slice number and a bit, not bitmaps: a task's rows fall in all slices of a filter for the whole table, so that bitmaps made
before the exchange would be as many bytes as the filter for every task, and more than the bits from four tasks on.

Defined results: a null text counts as empty, and all empty texts are one group; a null id is smaller than any other; of rows
equal in id and text exactly one stays; a table without rows gives none; texts of any length are hashed whole; columns may have any name,
those of exact_dedup() stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bloom
from .common import cut, lower_ascii, text_of

def text_sha256(text: str = "text") -> Column:
    return F.sha2(lower_ascii(text_of(text)).cast("binary"), 256)


def possibly_repeated(keyed: DataFrame, n_rows: int) -> DataFrame:
    """keyed, with `maybe`: false only where no other row has the same `h`."""
    slices = bloom.slices_for(n_rows)
    probes = keyed.withColumns(bloom.bits(F.col("h"), slices))
    # a row whose two bits are one bit sets it twice by itself: harmless, it only counts as a possible repeat
    twice = probes.select("slice", F.explode("bits").alias("bit")).groupBy("slice", "bit").count().filter("count >= 2")
    table = cut(twice.groupBy("slice").agg(F.bitmap_construct_agg(F.col("bit").cast("long")).alias("bitmap")))
    return bloom.probed(keyed, "h", table, slices)


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, keep_id (key of the row that stays), group_size, kept, text_sha256."""
    keyed = cut(docs.select(F.col(key).alias("id"), text_sha256(text).alias("sha")).withColumn("row", F.monotonically_increasing_id()))
    flagged = possibly_repeated(keyed.withColumn("h", F.xxhash64("sha")), keyed.count())
    maybe = flagged.filter("maybe").select("id", "sha", "row")
    # written before it is joined: both sides of the join are then plain exchanges, whose large partitions Spark can split
    groups = cut(maybe.groupBy("sha").agg(F.max(F.struct(F.col("id"), (-F.col("row")).alias("r"))).alias("best"), F.count("*").alias("group_size")))
    compared = maybe.join(groups, "sha").select("id", F.col("best.id").alias("keep_id"), "group_size", (F.col("best.r") == -F.col("row")).alias("kept"), "sha")
    alone = flagged.filter(~F.col("maybe")).select("id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "sha")
    return alone.unionByName(compared).select(F.col("id").alias(key), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256"))


def exact_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The input's rows that stay, all columns as they were. Texts aren't dealt out: rows that stay pass straight through, and only the ids and hashes
    of the others are sent to them; see bloom.without."""
    name = lambda i, sha: F.concat_ws(":", F.when(i.isNull(), "").otherwise(F.concat(F.lit("k"), i.cast("string"))), sha)
    groups = exact_groups(docs, key, text).filter("group_size > 1")
    groups = cut(groups.select(F.col(key).eqNullSafe(F.col("keep_id")).alias("same"), "kept", name(F.col(key), F.col("text_sha256")).alias("name")))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), name(F.col(key), text_sha256(text)).alias("name"))
    out = bloom.without(rows, cut(groups.filter("not same").select("name").distinct()), "name")
    twins = cut(groups.filter("same and not kept").select("name").distinct())
    if not twins.isEmpty():  # rows equal in id and text
        once = out.join(twins, "name", "left_semi").groupBy("name").agg(F.first("row").alias("row")).select("row", "name")
        out = bloom.without(out, twins, "name").select("row", "name").unionByName(once)
    return out.select("row.*")
