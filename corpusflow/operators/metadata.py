"""Document metadata: key/value maps and their long table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.functions.ids import stable_id


def present(entries: dict[str, Column]) -> Column:
    """Map of the non-null entries."""
    pairs = [x for name, value in entries.items() for x in (F.lit(name), value)]
    return F.map_filter(F.create_map(*pairs), lambda _, value: value.isNotNull())


def json_text(text: Column) -> Column:
    """A string as a JSON string."""
    return F.regexp_extract(F.to_json(F.struct(text.alias("v"))), r"(?s)^\{.v.:(.*)\}$", 1)


def long_rows(df: DataFrame, document: str, metadata: str, stamp: Column) -> DataFrame:
    """One row per document and key; documents without metadata give none.

    The outer form keeps Spark from testing the map, and so building it, twice.
    """
    pairs = df.select(F.col(document).alias("document_id"), F.explode_outer(metadata).alias("key", "meta"))
    return pairs.where(F.col("key").isNotNull()).select(
        stable_id("document_id", "key").alias("id"), "document_id", "key", "meta", stamp.alias("created_at")
    )
