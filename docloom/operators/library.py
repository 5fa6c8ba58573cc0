"""The library: versioned Parquet tables with merges, counts, the review queue and stage checkpoints.

A table's version is a list of the folders that hold its rows, one for each bucket of keys. Data is written first, the list last: a version whose
list isn't whole isn't there, so a lost task or driver leaves the old version in place, and readers never see half a table. Versions are numbered and never replaced; a merge writes the buckets that its updates fall into and lists the others as they are.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ERROR_CHARS = 2000
STAGES = ("ingest", "structure", "section", "classify", "extract", "compose", "validate", "link")
#: Buckets of a table that merges have made. A bucket is as many files as its rows need.
BUCKETS = 64


class Library:
    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        sc = spark.sparkContext
        self._fs = sc._jvm.org.apache.hadoop.fs
        self._conf = sc._jsc.hadoopConfiguration()

    def _numbers(self, folder: str) -> list[int]:
        """Numbers in a folder, of versions or of their data, broken-off ones too."""
        where = self._fs.Path(folder)
        fs = where.getFileSystem(self._conf)
        return sorted(int(n) for n in (s.getPath().getName() for s in fs.listStatus(where)) if n.isdigit()) if fs.exists(where) else []

    def _list_of(self, name: str, number: int) -> dict | None:
        """schema, keys, and folders by bucket of a version; None for one that broke off while it was written."""
        where = self._fs.Path(f"{self.path}/{name}/versions/{number:08d}")
        fs = where.getFileSystem(self._conf)
        if not fs.getFileStatus(where).isFile():
            return None
        stream = fs.open(where)
        try:
            return json.loads(bytes(stream.readAllBytes()))
        except ValueError:
            return None
        finally:
            stream.close()

    def _current(self, name: str) -> tuple[int, dict] | None:
        for number in reversed(self._numbers(f"{self.path}/{name}/versions")):
            listed = self._list_of(name, number)
            if listed is not None:
                return number, listed
        return None

    def version(self, name: str) -> int | None:
        """The number of the current version."""
        found = self._current(name)
        return found[0] if found else None

    def _listed(self, name: str) -> dict | None:
        """The list of the current version; tables that no merge has made have the one bucket -1."""
        found = self._current(name)
        return found[1] if found else None

    def _rows(self, name: str, listed: dict, buckets: set[int] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(listed["schema"])
        folders = [f for b, f in listed["folders"].items() if buckets is None or int(b) in buckets]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{name}/{f}" for f in folders])

    def read(self, name: str) -> DataFrame | None:
        listed = self._listed(name)
        return None if listed is None else self._rows(name, listed)

    def _next(self, name: str) -> int:
        """A number that no version, whole or broken off, has."""
        return 1 + max([0, *self._numbers(f"{self.path}/{name}/data"), *self._numbers(f"{self.path}/{name}/versions")])

    def _publish(self, name: str, number: int, schema: T.StructType, keys: list[str], folders: dict[int, str]) -> DataFrame:
        listed = {"schema": schema.jsonValue(), "keys": keys, "folders": {str(b): f for b, f in folders.items()}}
        where = self._fs.Path(f"{self.path}/{name}/versions/{number:08d}")
        stream = where.getFileSystem(self._conf).create(where, False)  # never over another writer's
        stream.write(bytearray(json.dumps(listed).encode()))
        stream.close()
        return self._rows(name, listed)

    def vacuum(self, name: str, keep: int = 2) -> None:
        """Removes data that the last `keep` whole versions don't list, and older lists."""
        lists = [(n, x) for n in self._numbers(f"{self.path}/{name}/versions") if (x := self._list_of(name, n)) is not None][-keep:]
        held = {f.split("/")[1] for _, x in lists for f in x["folders"].values()}
        for folder, kept in (("data", held), ("versions", {f"{n:08d}" for n, _ in lists})):
            for n in self._numbers(f"{self.path}/{name}/{folder}"):
                if lists and f"{n:08d}" not in kept and n < lists[-1][0]:
                    where = self._fs.Path(f"{self.path}/{name}/{folder}/{n:08d}")
                    where.getFileSystem(self._conf).delete(where, True)

    def replace(self, name: str, rows: DataFrame) -> DataFrame:
        """Writes a new version and makes it the current one."""
        number = self._next(name)
        rows.write.parquet(f"{self.path}/{name}/data/{number:08d}")
        return self._publish(name, number, rows.schema, [], {-1: f"data/{number:08d}"})

    def merge(self, name: str, updates: DataFrame, keys: list[str], order: str | None = None, rules: dict[str, str] | None = None) -> DataFrame:
        """Upsert: see merged(). Only the buckets that updates fall into are read and written."""
        bucket = F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("int")
        listed = self._listed(name)
        folders: dict[int, str] = {}
        if listed is None:
            out = merged(None, updates, keys, order, rules)
        elif listed["keys"] != [*keys, self.buckets]:  # written whole, or by other keys
            out = merged(self._rows(name, listed), updates, keys, order, rules)
        else:
            folders = {int(b): f for b, f in listed["folders"].items()}
            touched = {r[0] for r in updates.select(bucket).distinct().collect()}
            out = merged(self._rows(name, listed, touched), updates, keys, order, rules)
            folders = {b: f for b, f in folders.items() if b not in touched}
        number = self._next(name)
        place = f"data/{number:08d}"
        out.withColumn("__bucket", bucket).hint("rebalance", "__bucket").write.partitionBy("__bucket").parquet(f"{self.path}/{name}/{place}")
        where = self._fs.Path(f"{self.path}/{name}/{place}")
        found = [s.getPath().getName() for s in where.getFileSystem(self._conf).listStatus(where)]
        folders |= {int(n.partition("=")[2]): f"{place}/{n}" for n in found if n.startswith("__bucket=")}
        return self._publish(name, number, out.schema, [*keys, self.buckets], folders)


def latest(updates: DataFrame, keys: list[str], order: str | None) -> DataFrame:
    """One row per key: the last by order."""
    if order is None:
        return updates.dropDuplicates(keys)
    w = Window.partitionBy(*keys).orderBy(F.desc(order))
    return updates.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def merged(table: DataFrame | None, updates: DataFrame, keys: list[str], order: str | None = None, rules: dict[str, str] | None = None) -> DataFrame:
    """table with updates put in by key. Rules by column: new (the default) takes the update's value, keep the table's where there is one,
    fill the update's unless null."""
    new = latest(updates, keys, order)
    if table is None:
        return new
    rules = rules or {}
    n, t = new.alias("n"), table.alias("t")
    match = F.lit(True)
    for k in keys:
        match = match & F.col(f"n.{k}").eqNullSafe(F.col(f"t.{k}"))
    both = n.withColumn("__new", F.lit(True)).alias("n").join(t.withColumn("__old", F.lit(True)).alias("t"), match, "full")
    is_new, is_old = F.col("__new").isNotNull(), F.col("__old").isNotNull()

    def value(c: str) -> Column:
        if c not in new.columns:
            return F.col(f"t.{c}")
        if c not in table.columns:
            return F.col(f"n.{c}")
        a, b = F.col(f"n.{c}"), F.col(f"t.{c}")
        if c in keys:
            return F.when(is_new, a).otherwise(b)
        rule = rules.get(c, "new")
        if rule == "keep":
            return F.when(is_old, b).otherwise(a)
        return F.coalesce(a, b) if rule == "fill" else F.when(is_new, a).otherwise(b)

    columns = [*table.columns, *[c for c in new.columns if c not in table.columns]]
    return both.select(*[value(c).alias(c) for c in columns])


def topic_tree(topics: DataFrame, records: DataFrame) -> DataFrame:
    """topic_id, name, parent_id, n: records under each topic or subtopic, topics before subtopics, then by name."""
    each = records.select(F.explode(F.array_distinct(F.array("topic_id", "subtopic_id"))).alias("topic_id")).filter("topic_id is not null")
    counts = each.groupBy("topic_id").agg(F.count("*").alias("n"))
    return topics.join(counts, "topic_id", "left").select("topic_id", "name", "parent_id", F.coalesce("n", F.lit(0).cast("long")).alias("n")).orderBy(F.col("parent_id").isNotNull(), "name")


def documents_by_status(documents: DataFrame, status: str | None = None) -> DataFrame:
    """In order of arrival."""
    return (documents if status is None else documents.filter(F.col("status") == status)).orderBy("added_at", "doc_id")


def with_status(documents: DataFrame, changed: DataFrame) -> DataFrame:
    """documents with the status and error of those in `changed` (doc_id, status, error, updated_at)."""
    return merged(documents, changed.select("doc_id", "status", F.substring("error", 1, ERROR_CHARS).alias("error"), "updated_at"), ["doc_id"])


def record_of(records: DataFrame, record_id: str) -> DataFrame:
    """The record of an id: one row or none."""
    return records.filter(F.col("record_id") == record_id)


def records_in_order(records: DataFrame, record_type: str | None = None) -> DataFrame:
    return (records if record_type is None else records.filter(F.col("record_type") == record_type)).orderBy("record_id")


def record_rows(records: DataFrame) -> DataFrame:
    """The rows of the library's record table beside the record itself: title, topic ids, flags and search text."""
    own = {"title": record_title(), "topic_id": F.col("topic.id"), "subtopic_id": F.col("subtopic.id"), "needs_review": F.coalesce(F.col("status") == "HUMAN_REVIEW", F.lit(False)), "search_text": search_text()}
    return records.withColumns(own)


def evidence_rows(records: DataFrame) -> DataFrame:
    """record_id, evidence_id, doc_id, page_start, page_end."""
    return evidence_columns(records.select("record_id", F.explode("evidence").alias("e")))


def evidence_columns(own: DataFrame) -> DataFrame:
    """own: record_id and one piece of evidence e."""
    return own.select("record_id", F.col("e.id").alias("evidence_id"), "e.doc_id", F.array_min("e.pages").alias("page_start"), F.array_max("e.pages").alias("page_end"))


def counts(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(column).agg(F.count("*").alias("n"))


def record_title(record_type: str = "record_type") -> Column:
    """A case's name, else the record's; of an example without one the start of its scenario."""
    named = F.coalesce(*[F.when(F.col(c) != "", F.col(c)) for c in ("case_name", "name")])
    scenario = F.get(F.transform(F.filter("statements", lambda s: s["field"] == "scenario"), lambda s: F.substring(s["text"], 1, 80)), F.lit(0))
    return F.when(F.col(record_type) == "EXAMPLE", F.coalesce(scenario, named)).otherwise(named)


def search_text() -> Column:
    """Title, statements, laws, court, citation, subtopic and topic, as one text."""
    laws = F.transform("laws", lambda x: F.concat_ws(" ", x["provision"], x["statute"]))
    return F.concat_ws(" ", record_title(), F.transform("statements", lambda s: s["text"]), laws, "court", "citation", F.col("subtopic.name"), F.col("topic.name"))


# review queue


def review_rows(checked: DataFrame) -> DataFrame:
    """review_id, record_id, record_type, title, doc_id, section_id, reasons, status and data (the record as JSON) of the records that a person has to
    see. Merged into the queue by review_id, a record that comes again is pending again, with its new reasons and data."""
    from ..functions.ids import make_id

    own = checked.filter("status = 'HUMAN_REVIEW'")
    record = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    return own.select(make_id("rev", F.col("record_id"), F.col("section_id")).alias("review_id"), "record_id", "record_type", record_title().alias("title"), "doc_id", "section_id", F.col("review_reasons").alias("reasons"), F.lit("pending").alias("status"), record.alias("data"))


def reviews(queue: DataFrame, status: str = "pending", order: str = "created_at") -> DataFrame:
    return queue.filter(F.col("status") == status).orderBy(order, "review_id")


def decided(queue: DataFrame, review_id: str, status: str) -> DataFrame:
    """The queue with one review approved, rejected or superseded."""
    return queue.withColumn("status", F.when(F.col("review_id") == review_id, F.lit(status)).otherwise(F.col("status")))


# stage checkpoints: doc_id, stage, unit_id, status (running, done, failed), attempts, error, output_path, updated_at

UNIT = ["doc_id", "stage", "unit_id"]


def stage_state(events: DataFrame, order: str = "event_id") -> DataFrame:
    """events: doc_id, stage, unit_id, status and an order column. Per unit its last status and how often it was started."""
    return events.groupBy(*UNIT).agg(F.max_by("status", order).alias("status"), F.sum(F.when(F.col("status") == "running", 1).otherwise(0)).alias("attempts"))


def started(state: DataFrame | None, units: DataFrame) -> DataFrame:
    """State after units (doc_id, stage, unit_id, updated_at) were started: running, one more attempt, no error."""
    new = units.select(*UNIT, F.lit("running").alias("status"), F.lit(None).cast("string").alias("error"), "updated_at")
    out = merged(state, new.withColumn("__started", F.lit(1)) if state is not None else new.withColumn("attempts", F.lit(0)).withColumn("output_path", F.lit(None).cast("string")).withColumn("__started", F.lit(1)), UNIT)
    return out.withColumn("attempts", F.coalesce("attempts", F.lit(0)) + F.coalesce("__started", F.lit(0))).drop("__started")


def finished(state: DataFrame | None, units: DataFrame, status: str) -> DataFrame:
    """State after units (doc_id, stage, unit_id, error, output_path, updated_at) ended; attempts stay, an output path once known stays."""
    new = units.select(*UNIT, F.lit(status).alias("status"), F.substring("error", 1, ERROR_CHARS).alias("error"), "output_path", "updated_at")
    return merged(state, new if state is not None else new.withColumn("attempts", F.lit(0)), UNIT, rules={"output_path": "fill"})


def to_do(units: DataFrame, state: DataFrame, keys: list[str] = UNIT) -> DataFrame:
    """Units that aren't done yet."""
    return units.join(state.filter("status = 'done'").select(*keys).distinct(), keys, "left_anti")


def recovered(state: DataFrame) -> DataFrame:
    """What a broken-off run left running has failed."""
    running = F.col("status") == "running"
    return state.withColumns({"error": F.when(running, "interrupted").otherwise(F.col("error")), "status": F.when(running, "failed").otherwise(F.col("status"))})


def reset(state: DataFrame, doc_id: str, stages: tuple[str, ...] = STAGES) -> DataFrame:
    return state.filter(~((F.col("doc_id") == doc_id) & F.col("stage").isin(*stages)))


def failures(state: DataFrame, doc_id: str | None = None) -> DataFrame:
    own = state.filter("status = 'failed'")
    return (own if doc_id is None else own.filter(F.col("doc_id") == doc_id)).orderBy("updated_at", *UNIT)


def stage_summary(state: DataFrame) -> DataFrame:
    """Units of each stage by status, one column for each status."""
    return state.groupBy("stage").pivot("status", ["running", "done", "failed"]).count().fillna(0)
