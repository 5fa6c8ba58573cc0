"""What several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import dealt

#: A word is a maximal run of anything but these six white-space characters.
SPACES = " \t\n\x0b\x0c\r"
SEPARATOR = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
#: Rows of ids and hashes, about 100 bytes each, that are sent to all tasks at most; every broadcast is preceded by a count.
BROADCAST_ROWS = 200_000
#: Rows of one key that one task takes at least before the key counts as hot, and the hot keys that a table can have at most.
HOT_ROWS, HOT_KEYS = 1000, 20_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder; one with fewer splits than cores is dealt out to all of them."""
    return dealt(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """Array of the words of a non-null text; empty when there is none."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SEPARATOR))


def n_words_of(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else. Java's lower() may only be used where all bytes are ASCII."""
    upper = "".join(map(chr, range(65, 91)))
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def let(value: Column, body) -> Column:
    """body(value) with the value computed once: a lambda variable is bound to it."""
    return F.transform(F.array(value), body)[0]


def give_back() -> None:
    """Returns to the system what Arrow and the C library hold unused: a Python worker outlives its task, and so would the memory of its largest batch."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def ready(spark: SparkSession) -> None:
    """Checkpoints go to the shared folder the cluster names; only a local session may fall back on a folder of its own."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            folder = tempfile.mkdtemp(prefix="docloom-checkpoint-")
        sc.setCheckpointDir(folder)


def cut(df: DataFrame) -> DataFrame:
    """The same rows, written to the shared checkpoint folder and free of lineage; columns should be few and narrow."""
    ready(df.sparkSession)
    return df.checkpoint()


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder."""
    ready(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame) -> tuple[DataFrame, str]:
    """The same rows from a Parquet table in the shared checkpoint folder, and its path for discard(). For tables too large to cut()."""
    spark = df.sparkSession
    path = scratch(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Removes a saved table that no later step reads."""
    sc = spark.sparkContext
    where = sc._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)


def spread(rows: DataFrame, table: DataFrame, on: list[str], n_rows: int, size: str = "size") -> DataFrame:
    """rows with the columns of their key's row in `table`, which has one row for each key and the key's number of rows in `size`; inner. Keys
    with more than a HOT_KEYS-th of the rows, of which there can't be more than HOT_KEYS, are sent to all tasks: their rows stay where they are.
    Both tables are read twice and should have been written."""
    most = max(HOT_ROWS, n_rows // HOT_KEYS)
    hot = table.filter(F.col(size) > most)
    cold = rows.join(F.broadcast(hot.select(*on)), on, "left_anti").join(table.filter(F.col(size) <= most), on)
    return rows.join(F.broadcast(hot), on).unionByName(cold)
