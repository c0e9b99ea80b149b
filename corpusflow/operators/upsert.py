"""Keyed table changes as DataFrames: upsert, insert, update, delete, retention.

Each returns the new content of the table; ``sources.snapshots`` stores it. The
table side is never sorted or grouped: updates are reduced to one row per key
first (each task keeps one row per key before the shuffle, so a hot key stays
small), then the table only joins against that reduced side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.session import materialize


def newest_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """First ``n`` rows of each key in the given order.

    Spark evaluates the rank limit before and after the shuffle, so of a key that
    holds a third of the rows each task sends on ``n`` rows only.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rank") <= n).drop("_rank")


def row_marks(df: DataFrame, purpose: str) -> DataFrame:
    """The rows, written once, each with a number of its own (_row) that every later reading agrees on."""
    return materialize(df.withColumn("_row", F.monotonically_increasing_id()), purpose)


def newest_rows(df: DataFrame, keys: list[str], time: Column, fingerprint: Column) -> DataFrame:
    """The newest row of each key, ties to the smaller fingerprint; wide columns are never sorted.

    Rows are written once with a number. Keys, time, fingerprint and number are ranked alone, and one
    join picks the rows by number, whose hashed side is the numbers.
    """
    marked = row_marks(df.withColumns({"_time": time, "_print": fingerprint}), "arrived")
    order = [F.col("_time").desc_nulls_last(), F.col("_print"), F.col("_row")]
    best = newest_per_key(marked.select(*keys, "_time", "_print", "_row"), keys, order).select("_row")
    return marked.join(best.hint("shuffle_hash"), "_row", "left_semi").drop("_time", "_print", "_row")


def upsert(base: DataFrame, updates: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Rows of ``updates`` replace those of ``base`` with the same key; the first in order wins."""
    latest = newest_per_key(updates, keys, order)
    replaced = updates.select(*keys).distinct()
    return base.join(replaced, keys, "left_anti").unionByName(latest.select(*base.columns))


def insert_absent(base: DataFrame, new: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Add only rows whose key is not there yet (conflict: do nothing)."""
    first = newest_per_key(new, keys, order)
    return base.unionByName(first.join(base.select(*keys), keys, "left_anti").select(*base.columns))


def insert_checked(
    base: DataFrame, new: DataFrame, key: str, checks: dict[str, Column], order: list[Column]
) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) rows of ``new``; ``checks`` maps an error code to its violation.

    Rejected are rows that violate a check, repeat a key within ``new`` or bring a
    key the table has already.
    """
    error = F.coalesce(*[F.when(F.coalesce(bad, F.lit(True)), code) for code, bad in checks.items()])
    columns = new.columns
    # Equal rows become one row with a count, so that ranking sees every row once and
    # a key brought many times is reduced within each task.
    distinct = new.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies")).withColumn("error", error)
    fingerprint = F.xxhash64(*columns)
    valid = distinct.where(F.col("error").isNull()).select(*columns)
    winners = newest_per_key(valid, [key], [*order, fingerprint]).select(key, fingerprint.alias("_winner"))
    seen = base.select(F.col(key), F.lit(True).alias("_seen"))
    # Both are one narrow row per key; joined to each other first, they leave the rows
    # a single join, which Spark may split where a key is hot.
    marks = winners.join(seen, key, "full_outer")
    judged = (
        distinct.withColumn("_fingerprint", fingerprint)
        .join(marks, key, "left")
        .withColumn("_taken", F.col("error").isNull() & F.col("_seen").isNull()
                    & F.col("_fingerprint").eqNullSafe(F.col("_winner")))
    )
    accepted = judged.where("_taken").select(*base.columns)
    refused = F.col("_copies") - F.col("_taken").cast("int")
    rejected = judged.where(refused > 0).select(
        *columns,
        F.coalesce("error", F.lit("ErrDuplicateKey")).alias("error"),
        F.explode(F.sequence(F.lit(1), refused)).alias("_copy"),
    )
    return accepted, rejected.drop("_copy")


def update(base: DataFrame, changes: DataFrame, key: str, columns: list[str], stamp: Column) -> DataFrame:
    """Overwrite ``columns`` (nulls too) and ``updated_at`` of matching rows; unknown keys change nothing."""
    change = changes.select(F.col(key), F.struct(*columns).alias("_new"))
    joined = base.join(change, key, "left")
    hit = F.col("_new").isNotNull()

    def value(name: str) -> Column:
        if name in columns:
            return F.when(hit, F.col(f"_new.{name}")).otherwise(F.col(name)).alias(name)
        if name == "updated_at":
            return F.when(hit, stamp).otherwise(F.col(name)).alias(name)
        return F.col(name)

    return joined.select(*[value(name) for name in base.columns])


def delete(base: DataFrame, doomed: DataFrame, keys: list[str]) -> DataFrame:
    """Table without the given keys; unknown keys change nothing."""
    return base.join(doomed.select(*keys), keys, "left_anti")


def lookup(base: DataFrame, wanted: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(found rows, wanted keys that are absent)."""
    found = base.join(wanted.select(key), key, "left_semi")
    missing = wanted.select(key).join(base.select(key), key, "left_anti")
    return found, missing.withColumn("error", F.lit("ErrNotFound"))


def retained_ids(downloads: DataFrame, n: int) -> DataFrame:
    """Id and source of the newest ``n`` downloads of each source; undated ones count as oldest.

    Ranks keys only, so bodies are neither read nor sorted.
    """
    order = [F.col("downloaded_at").desc_nulls_last(), F.col("id").desc()]
    keys = downloads.select("id", "source_id", "downloaded_at")
    return newest_per_key(keys, ["source_id"], order, n).select("id", "source_id")


def retain_newest(downloads: DataFrame, n: int = 3) -> DataFrame:
    """The newest ``n`` downloads of each source, bodies included."""
    return downloads.join(retained_ids(downloads, n).select("id").hint("shuffle_hash"), "id", "left_semi")


def merge_downloads(current: DataFrame, arrived: DataFrame, keep: int = 3, gone: DataFrame | None = None) -> DataFrame:
    """Downloads after new ones: newest per id, then the newest few per source; those of sources that are ``gone`` leave.

    Only sources that got something are worked on; the rows of others pass through.
    All rows are written once with a number. Keys alone are ranked; bodies meet the numbers that stay in one join.
    """
    fingerprint = F.xxhash64("source_id", "attempted_at", "status_code", "headers")
    both = current.withColumn("_new", F.lit(False)).unionByName(arrived.select(*current.columns).withColumn("_new", F.lit(True)))
    marked = row_marks(both.withColumn("_print", fingerprint), "merged_downloads")
    rows = marked.select("id", "source_id", "downloaded_at", "_print", "_row", "_new")
    if gone is not None:
        rows = rows.join(gone.select("source_id"), "source_id", "left_anti")
    touched = marked.where("_new").select("source_id").distinct().withColumn("_touched", F.lit(True))
    rows = rows.join(touched, "source_id", "left")
    worked_on = F.col("_new") | F.col("_touched").isNotNull()
    affected = rows.where(worked_on)
    latest = affected.groupBy("id", "source_id").agg(F.max("downloaded_at").alias("downloaded_at"))
    kept = affected.join(retained_ids(latest, keep).select("id"), "id", "left_semi")
    order = [F.col("downloaded_at").desc_nulls_last(), F.col("_print"), F.col("_row")]
    staying = newest_per_key(kept, ["id"], order).select("_row").unionByName(rows.where(~worked_on).select("_row"))
    return marked.join(staying.hint("shuffle_hash"), "_row", "left_semi").select(*current.columns)
