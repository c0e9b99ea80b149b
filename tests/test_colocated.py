"""Bucketed tables join without a shuffle."""

import pytest
from pyspark.sql import functions as F

from corpusflow.checks import run_queries
from corpusflow.operators.chunks import token_chunks
from corpusflow.options import ChunkOptions
from corpusflow.plans import colocated
from corpusflow.session import materialize, work_dir


@pytest.fixture
def published(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(F.col("doc_id").cast("string").alias("id"), "text")
    dated = docs.select("id", F.lit("s").alias("source_id"), F.lit("json").alias("format"), *[F.lit(None).cast("timestamp").alias(c) for c in ("published_at", "modified_at")])
    chunks = token_chunks(docs, "id", "text", ChunkOptions(max_tokens=50))
    vectors = chunks.select(F.concat("id", F.lit("m")).alias("id"), F.col("id").alias("object_id"), F.lit("chunk").alias("object_type"), F.lit("m").alias("model"))
    for _ in range(2):
        colocated.publish(spark, work_dir(spark, "published"), dated, chunks, vectors, "colocated_test", buckets=4)
    before = {k: spark.conf.get(k) for k in colocated.SUBSET_OF_KEYS}
    own = {**colocated.SUBSET_OF_KEYS, "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before["spark.sql.autoBroadcastJoinThreshold"] = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for k, v in own.items():
        spark.conf.set(k, v)
    yield chunks.count()
    for k, v in before.items():
        spark.conf.set(k, v)
    spark.sql("drop database colocated_test cascade")


def test_joins_without_exchange(spark, published):
    joins = {f.__name__: f(spark, "colocated_test") for f in (colocated.chunks_with_documents, colocated.chunks_with_vectors, colocated.with_neighbours)}
    for name, df in joins.items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan, f"{name}: {plan}"
        assert df.count() == published
    near = joins["with_neighbours"]
    assert near.where(F.col("left_chunk_id").isNotNull() & F.col("left_body").isNull()).count() == 0
    assert near.where(F.col("left_chunk_id").isNull() & F.col("left_body").isNotNull()).count() == 0


def test_published_tables_join_bucket_by_bucket(spark, tmp_path, monkeypatch):
    """The query shuffles no chunk body to find its neighbours, and its tables are written with zstd."""
    made = []

    def looked_at(df, purpose):
        if purpose == "neighbours":
            made.append(df._jdf.queryExecution().executedPlan().toString())
        return materialize(df, purpose)

    monkeypatch.setattr(run_queries, "materialize", looked_at)
    monkeypatch.setattr(run_queries, "work_dir", lambda spark, purpose: str(tmp_path / purpose))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert run_queries.published_tables(spark, "/root/testdata/sf0.001").count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(made) == 1 and "Exchange" not in made[0] and "SortMergeJoin" in made[0]
    assert all(".zstd." in p.name for p in (tmp_path / "published").rglob("*.parquet"))
    assert {spark.conf.get(k) for k in colocated.SUBSET_OF_KEYS} == {"true"}
