"""Incremental forms: files and records that arrive over time are merged into the library batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.library import Library
from ..operators.link import store_records


def incoming_files(spark: SparkSession, path: str, suffix: str = ".pdf") -> DataFrame:
    """A stream of new files: path, length, content."""
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("recursiveFileLookup", "true").load(path)
    return files.filter(F.lower("path").endswith(suffix))


def merge_stream(stream: DataFrame, library: Library, name: str, keys: list[str], order: str | None, checkpoint: str, rules: dict[str, str] | None = None, prepare: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Upserts each micro-batch. A batch that is run again after a failure gives the same table: the last row by `order` wins."""

    def run(batch: DataFrame, _: int) -> None:
        rows = prepare(batch) if prepare else batch
        if not rows.isEmpty():
            library.merge(name, rows, keys, order, rules)

    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def merge_records_stream(stream: DataFrame, library: Library, checkpoint: str) -> StreamingQuery:
    """Stores records as they arrive: all occurrences are kept (one row for each record, document and section), and the touched records are folded again
    in their fixed order, so that the result doesn't depend on the order of arrival."""

    def run(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            store_records(library, batch)

    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
