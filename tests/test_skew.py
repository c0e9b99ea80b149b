"""A third of all rows on one key: same results, small tasks."""

import pytest
from pyspark.sql import functions as F

from corpusflow.operators import integrity, tags, upsert
from corpusflow.schemas import ReferenceRule

ROWS = 30000


@pytest.fixture
def skewed(spark):
    """Rows whose source is 0 for every third one."""
    rows = spark.range(ROWS).select(
        F.concat(F.lit("d"), F.col("id").cast("string")).alias("id"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500).cast("string").alias("source_id"),
        F.timestamp_seconds((F.col("id") * 7919) % ROWS).alias("downloaded_at"),
        F.repeat(F.lit("x"), 50).alias("body"),
    )
    return rows.repartition(8)


def by_hand(skewed, n):
    groups = {}
    for row in skewed.collect():
        groups.setdefault(row.source_id, []).append((row.downloaded_at, row.id))
    return {id for rows in groups.values() for _, id in sorted(rows, reverse=True)[:n]}


def test_retention(skewed):
    assert {r.id for r in upsert.retain_newest(skewed, 3).collect()} == by_hand(skewed, 3)


def test_only_ranked_rows_are_shuffled(spark, skewed):
    ranked = upsert.retained_ids(skewed, 1)
    ranked.collect()
    plan = ranked._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert "body" not in text.split("Exchange hashpartitioning(source_id")[0]
    assert "WindowGroupLimit" in text.split("Exchange hashpartitioning(source_id")[1]


def test_upsert(skewed):
    order = [F.col("downloaded_at").desc(), F.col("id").desc()]
    base = skewed.where("source_id < '3'").dropDuplicates(["source_id"])
    merged = upsert.upsert(base, skewed, ["source_id"], order)
    assert {r.id for r in merged.collect()} == by_hand(skewed, 1)


def test_checked_insert(spark, skewed):
    new = skewed.select(F.col("source_id").alias("id"), "body")
    accepted, rejected = upsert.insert_checked(new.limit(0), new, "id", {"ErrBlank": F.col("body") == ""}, [F.col("body")])
    keys = skewed.select("source_id").distinct().count()
    assert accepted.count() == keys and rejected.count() == ROWS - keys


def test_tags(spark, skewed):
    now = F.lit("2024-01-01 00:00:00").cast("timestamp")
    terms = skewed.select(F.col("id").alias("document_id"), F.concat(F.lit("t"), "source_id").alias("name"))
    none = spark.createDataFrame([], "id string, name string, created_at timestamp")
    links = spark.createDataFrame([], "id string, document_id string, tag_id string, created_at timestamp")
    all_tags, all_links = tags.link(terms, none, links, now)
    assert all_tags.count() == skewed.select("source_id").distinct().count() and all_links.count() == ROWS


def test_orphans(skewed):
    targets = skewed.where("source_id <> '0'").select(F.col("source_id").alias("id")).distinct()
    lost = integrity.orphans(skewed, targets, ReferenceRule("downloads", "source_id", "sources"))
    assert lost.count() == skewed.where("source_id = '0'").count() >= ROWS // 3
