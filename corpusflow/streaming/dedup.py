"""Duplicate suppression with bounded state; rows that come too late are kept as rejects.

Two queries share a folder. ``route`` parts arrivals by the watermark, so that nothing vanishes in a stateful
operator: rows older than it go to ``late``, the others to ``arrivals``. ``suppress`` reads these
and lets the first row of a key through; its state holds the keys of one delay and no more. The first
query is never behind the second, so the second finds no late row.

Ingest itself needs neither (repeats meet by their id when rows are merged); this is for
consumers of the stream that must not see a delivery twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusflow.sources.snapshots import complete_snapshots, write_snapshot

ARRIVALS, LATE, ACCEPTED, MARKS = "arrivals", "late", "accepted", "marks"


def _mark(spark: SparkSession, root: str, number: int) -> DataFrame | None:
    """The largest time of all batches before this one: one row."""
    done = [n for n in complete_snapshots(spark, root, MARKS) if n < number]
    return spark.read.parquet(f"{root}/{MARKS}/snapshot={done[-1]}") if done else None


def route(stream: DataFrame, time: str, delay: str, root: str, checkpoint: str) -> StreamingQuery:
    """Part a stream into rows on time and late ones; ends when the input is used up.

    A row is late if its time is not after the largest time of the batches before, less the delay, nor after
    1970-01-01, where every watermark starts. Rows without a time are late. Batches and their folders have the same numbers, so a batch that runs again
    writes the same.
    """

    def part(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = _mark(spark, root, number)
        at = F.col(time)
        if before is None:
            marked = batch.withColumn("_before", F.lit(None).cast("timestamp"))
        else:
            marked = batch.crossJoin(F.broadcast(before.toDF("_before")))  # one row
        start = F.timestamp_seconds(F.lit(0))
        late = F.coalesce(at <= F.greatest(start, F.col("_before") - F.expr(f"interval {delay}")), F.lit(True))
        marked = marked.withColumn("_late", late).persist()
        try:
            write_snapshot(marked.where(~F.col("_late")).drop("_late", "_before"), root, ARRIVALS, number)
            write_snapshot(marked.where("_late").drop("_late", "_before"), root, LATE, number)
            write_snapshot(marked.agg(F.max(F.greatest(at, F.col("_before"))).alias("time")), root, MARKS, number)
        finally:
            marked.unpersist()

    return stream.writeStream.foreachBatch(part).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def suppress(
    spark: SparkSession, schema: str, keys: list[str], time: str, delay: str, root: str, checkpoint: str, files_at_once: int | None = None
) -> StreamingQuery:
    """Write the first row of each key to ``accepted``; ends when the arrivals are used up.

    A key that comes again within the delay of its first row is a repeat. After that its state is gone, as soon as the
    watermark has passed it, and it counts as new.
    """
    reader = spark.readStream.schema(f"{schema}, snapshot int")
    if files_at_once:
        reader = reader.option("maxFilesPerTrigger", files_at_once)
    arrived = reader.parquet(f"{root}/{ARRIVALS}").drop("snapshot")
    first = arrived.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)

    def keep(batch: DataFrame, number: int) -> None:
        write_snapshot(batch, root, ACCEPTED, number)

    return first.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read(spark: SparkSession, root: str, table: str, schema: str) -> DataFrame:
    """All rows of ``accepted`` or ``late`` so far."""
    folders = [f"{root}/{table}/snapshot={n}" for n in complete_snapshots(spark, root, table)]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)
