"""Deterministic identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def make_id(prefix: str, *parts: Column | str) -> Column:
    """prefix_ and 16 hex digits of the SHA-256 of the parts joined with a vertical bar; nulls count as empty."""
    columns = [F.coalesce(p.cast("string"), F.lit("")) if isinstance(p, Column) else F.lit(p) for p in parts]
    return F.concat(F.lit(f"{prefix}_"), F.substring(F.sha2(F.concat_ws("|", *columns).cast("binary"), 256), 1, 16))


def content_id(content: Column) -> Column:
    """Id of a file or text by its bytes."""
    return F.concat(F.lit("doc_"), F.substring(F.sha2(content.cast("binary"), 256), 1, 16))


def collapsed(name: Column) -> Column:
    """Lower case, runs of white space as one blank."""
    return F.trim(F.regexp_replace(F.lower(name), r"(?U)\s+", " "))


def topic_id(topic: Column) -> Column:
    return make_id("top", collapsed(topic))


def subtopic_id(topic: Column, name: Column) -> Column:
    return make_id("sub", collapsed(F.coalesce(topic, F.lit(""))), collapsed(name))
