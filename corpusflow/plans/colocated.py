"""Documents, chunks and vectors as bucketed catalog tables that join without a shuffle.

The stored tables of ``plans.store`` are laid out for changes. These are a copy laid out for readers: all
three are bucketed by the document, one file a bucket, so a join of chunks with their document, their
neighbours or their vectors reads bucket by bucket. Publishing again replaces the tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.session import COMPRESSION, shuffles_freed

#: Spark wants all keys of a join hashed unless this is off; here the document alone deals the rows.
SUBSET_OF_KEYS = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}


@contextmanager
def bucket_by_bucket(spark: SparkSession) -> Iterator[None]:
    """Joins that run in here go without a shuffle."""
    before = {name: spark.conf.get(name) for name in SUBSET_OF_KEYS}
    for name, value in SUBSET_OF_KEYS.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def publish(
    spark: SparkSession, path: str, documents: DataFrame, chunks: DataFrame, embeddings: DataFrame, database: str = "default", buckets: int = 256
) -> None:
    """Write the tables ``documents``, ``chunks`` and ``vectors`` of a database below a path.

    Vectors get the document of their chunk; those without a chunk are left out. ``buckets`` should make a bucket of
    the largest table a few hundred megabytes.
    """
    homes = chunks.select(F.col("id").alias("object_id"), "document_id")
    tables = {
        "documents": documents.withColumn("document_id", F.col("id")),
        "chunks": chunks,
        "vectors": embeddings.join(homes, "object_id"),
    }
    spark.sql(f"create database if not exists `{database}`")
    for name, df in tables.items():
        # Dealt as the buckets are, so that each is one file.
        writer = df.repartition(buckets, "document_id").write.mode("overwrite").options(**COMPRESSION).option("path", f"{path}/{name}")
        with shuffles_freed(spark):
            writer.bucketBy(buckets, "document_id").sortBy("document_id").saveAsTable(f"`{database}`.`{name}`")


def chunks_with_documents(spark: SparkSession, database: str = "default") -> DataFrame:
    """Chunks with source, format and dates of their document."""
    document = ["source_id", "format", "published_at", "modified_at"]
    documents = spark.table(f"`{database}`.`documents`").select("document_id", *document)
    return spark.table(f"`{database}`.`chunks`").join(documents, "document_id")


def chunks_with_vectors(spark: SparkSession, database: str = "default") -> DataFrame:
    """A row for each chunk and model, with the vector columns. Needs SUBSET_OF_KEYS to go without a shuffle."""
    vectors = spark.table(f"`{database}`.`vectors`").drop("id", "object_type").withColumnRenamed("object_id", "id")
    return spark.table(f"`{database}`.`chunks`").join(vectors, ["document_id", "id"])


def with_neighbours(spark: SparkSession, database: str = "default") -> DataFrame:
    """Chunks with the bodies of their left and right neighbours (left_body, right_body), null at the ends."""
    chunks = spark.table(f"`{database}`.`chunks`")
    out = chunks
    for side in ("left", "right"):
        other = chunks.select("document_id", F.col("id").alias(f"{side}_chunk_id"), F.col("body").alias(f"{side}_body"))
        out = out.join(other, ["document_id", f"{side}_chunk_id"], "left")
    return out
