"""A Bloom filter built by Spark and read either by a join on its slices or by numpy in a Python worker.

Two bits a value, inside one slice of 32768 bits; bits are chosen from a 64-bit hash column. A filter is a prefilter only: every
user checks what it lets through exactly, so a filter that is small for its values costs time and no correctness.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, cut

SLICE_BITS = 15
BITS_PER_VALUE = 16
#: The largest filter that is broadcast; for more values than it has bits for, it lets more through.
MOST_BYTES = 64 << 20


def slices_for(n: int, most_bytes: int | None = None) -> int:
    slices = 1
    while slices << SLICE_BITS < BITS_PER_VALUE * n and (most_bytes is None or 2 * slices << SLICE_BITS <= 8 * most_bytes):
        slices *= 2
    return slices


def bits(h: Column, slices: int) -> dict[str, Column]:
    return {
        "slice": F.pmod(h, F.lit(slices)).cast("int"),
        "bits": F.array(F.shiftrightunsigned(h, 64 - SLICE_BITS).cast("int"), F.shiftrightunsigned(F.shiftleft(h, SLICE_BITS), 64 - SLICE_BITS).cast("int")),
    }


def table(values: DataFrame, h: str, slices: int) -> DataFrame:
    """slice and bitmap of the filter that holds all values of column h."""
    each = values.select(F.col(h).alias("h")).withColumns(bits(F.col("h"), slices)).select("slice", F.explode("bits").alias("bit"))
    return each.groupBy("slice").agg(F.bitmap_construct_agg(F.col("bit").cast("long")).alias("bitmap"))


def sent(values: DataFrame, h: str, n: int) -> tuple[DataFrame, int]:
    """The filter of the n values of column h for probed(), with its number of slices. Up to MOST_BYTES it goes to all tasks, so that the rows it is
    asked about stay where they are; a larger one is dealt out by slice, and so are they."""
    slices = slices_for(n)
    held = table(values, h, slices)
    return F.broadcast(cut(held)) if fits(n) else held, slices


def fits(n: int) -> bool:
    """Whether a filter of n values may go to all tasks."""
    return slices_for(n) << SLICE_BITS <= 8 * MOST_BYTES


def is_set(bitmap: Column, bit: Column) -> Column:
    """bitmap_construct_agg keeps bit b in byte b div 8, lowest bit first."""
    byte = F.conv(F.hex(F.substr(bitmap, F.shiftright(bit, 3) + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte.cast("long"), bit.bitwiseAND(F.lit(7))) == 1


def without(rows: DataFrame, gone: DataFrame, name: str) -> DataFrame:
    """rows whose column `name` isn't in `gone` (a written table of that column alone). Few names are sent to all tasks; of many a filter is, at most
    MOST_BYTES large: rows that it rules out stay where they are, the others are dealt out by name."""
    n = gone.count()
    if n <= BROADCAST_ROWS:
        return rows.join(F.broadcast(gone), name, "left_anti") if n else rows
    slices = slices_for(n, MOST_BYTES)
    held = cut(table(gone.withColumn("h", F.xxhash64(name)), "h", slices))
    marked = probed(rows.withColumn("__bloom_h", F.xxhash64(name)), "__bloom_h", F.broadcast(held), slices, "__bloom").drop("__bloom_h")
    likely = marked.filter("__bloom").drop("__bloom").join(gone, name, "left_anti")
    return marked.filter("not __bloom").drop("__bloom").unionByName(likely)


def probed(rows: DataFrame, h: str, filter_table: DataFrame, slices: int, name: str = "maybe") -> DataFrame:
    """rows with a boolean column: false only where h isn't among the filter's values."""
    held = rows.withColumns(bits(F.col(h), slices)).join(filter_table, "slice", "left")
    hit = F.col("bitmap").isNotNull() & is_set(F.col("bitmap"), F.col("bits")[0]) & is_set(F.col("bitmap"), F.col("bits")[1])
    return held.withColumn(name, F.coalesce(hit, F.lit(False))).drop("slice", "bits", "bitmap")


class Bits:
    """The filter as one numpy array, at most MOST_BYTES long."""

    def __init__(self, values: DataFrame, h: str, n: int):
        self.slices = slices_for(n, MOST_BYTES)
        self.array = np.zeros((self.slices, 1 << SLICE_BITS - 3), dtype=np.uint8)
        for row in table(values, h, self.slices).collect():
            self.array[row["slice"]] = np.frombuffer(row["bitmap"], dtype=np.uint8)

    def has(self, h: np.ndarray) -> np.ndarray:
        """h: uint64 of the same 64 bits as the Spark column."""
        own = (h & np.uint64(self.slices - 1)).astype(np.int64)
        out = np.ones(len(h), dtype=bool)
        for bit in (h >> np.uint64(64 - SLICE_BITS), (h << np.uint64(SLICE_BITS)) >> np.uint64(64 - SLICE_BITS)):
            out &= (self.array[own, (bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return out
