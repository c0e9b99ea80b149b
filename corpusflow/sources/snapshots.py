"""Tables as snapshot folders.

A write never touches what readers use: it fills ``root/table/snapshot=<n>`` and
counts from its ``_SUCCESS`` mark on. Writing the same number again replaces the
same folder, so a repeated job or micro-batch gives the same table. On a catalog
with MERGE, ``DataFrame.mergeInto`` takes the place of upsert plus snapshot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusflow.schemas import SCHEMAS, empty_table


def _folder(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def complete_snapshots(spark: SparkSession, root: str, table: str) -> list[int]:
    """Numbers of the finished snapshots, ascending; one entry per run, not per row."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_folder(root, table))
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    marks = files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(path, "snapshot=*/_SUCCESS"))
    return sorted(int(mark.getPath().getParent().getName().split("=")[1]) for mark in marks)


def read_snapshot(
    spark: SparkSession, root: str, table: str, before: int | None = None, schema: str | None = None
) -> DataFrame:
    """Newest finished snapshot (older than ``before``); an empty table if there is none."""
    done = [n for n in complete_snapshots(spark, root, table) if before is None or n < before]
    if not done:
        return spark.createDataFrame([], schema) if schema else empty_table(spark, table)
    return spark.read.schema(schema or SCHEMAS[table]).parquet(f"{_folder(root, table)}/snapshot={done[-1]}")


def read_parts(spark: SparkSession, root: str, table: str, numbers: list[int], schema_of: str) -> DataFrame:
    """Several numbered folders of one table together."""
    folders = [f"{_folder(root, table)}/snapshot={n}" for n in numbers]
    return spark.read.schema(SCHEMAS[schema_of]).parquet(*folders)


def write_snapshot(df: DataFrame, root: str, table: str, number: int) -> None:
    df.write.mode("overwrite").parquet(f"{_folder(root, table)}/snapshot={number}")


def expire_snapshots(spark: SparkSession, root: str, table: str, keep: int) -> None:
    """Delete all but the newest finished snapshots. Readers of older ones must be done."""
    for number in complete_snapshots(spark, root, table)[:-keep]:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{_folder(root, table)}/snapshot={number}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
