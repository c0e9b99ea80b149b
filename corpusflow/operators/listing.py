"""Listings of the stored tables and their JSON form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.functions import times


def parse_times(df: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with the text columns as timestamps, rows with a text that is no time)."""
    errors = F.coalesce(*[times.stored_time_error(F.col(c)) for c in columns])
    judged = df.withColumn("error", errors)
    good = judged.where(F.col("error").isNull()).drop("error")
    return (
        good.withColumns({c: times.parse_stored_time(F.col(c)) for c in columns}),
        judged.where(F.col("error").isNotNull()),
    )


def newest_sources(sources: DataFrame) -> DataFrame:
    return sources.orderBy(F.col("created_at").desc_nulls_last(), "id")


def newest_documents(documents: DataFrame) -> DataFrame:
    return documents.orderBy(F.col("indexed_at").desc_nulls_last(), "id")


def first_sources(sources: DataFrame, n: int) -> DataFrame:
    """The ``n`` newest sources; each task keeps n rows."""
    return newest_sources(sources).limit(n)


def of_hosts(sources: DataFrame, hosts: list[str]) -> DataFrame:
    return sources.where(F.col("host").isin(hosts))


def json_rows(df: DataFrame) -> DataFrame:
    """One JSON text per row, time stamps in UTC notation."""
    columns = [
        times.format_utc(F.col(f.name)).alias(f.name) if f.dataType.typeName() == "timestamp" else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(F.to_json(F.struct(*columns)).alias("json"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, df in tables.items()
    ]
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return out


def result_chunk_ids(requests: DataFrame) -> DataFrame:
    """One row per chunk a request names; the list is a JSON array or comma-separated."""
    text: Column = F.col("result_chunks")
    listed = F.coalesce(
        F.from_json(text, "array<string>"), F.transform(F.split(text, ","), lambda part: F.trim(part))
    )
    return requests.where(text.isNotNull() & (text != "")).select(
        F.col("id").alias("request_id"), F.posexplode(listed).alias("pos", "chunk_id")
    )


def expand_requests(requests: DataFrame, chunks: DataFrame) -> DataFrame:
    """The chunks each request found, in order."""
    return result_chunk_ids(requests).join(chunks.withColumnRenamed("id", "chunk_id"), "chunk_id")
