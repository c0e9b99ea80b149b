"""Landed responses as a stream into the downloads table.

A micro-batch only appends its own rows, so its cost follows the batch and not the
table. ``current_downloads`` reads table and appended rows as one; ``compact`` folds
the appended rows into the table, as often as the reader's share of the work asks.

Repeats need no state in the stream: a download's id follows from its source and body, so
a second delivery, however late, meets the first one where the rows are merged. Nothing
is dropped for coming late.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from corpusflow.operators.upsert import merge_downloads
from corpusflow.sources.snapshots import complete_snapshots, read_parts, read_snapshot, write_snapshot

TABLE, LOG = "downloads", "downloads_log"


def ingest(
    stream: DataFrame,
    to_downloads: Callable[[DataFrame], DataFrame],
    root: str,
    checkpoint: str,
    process: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Append a stream of responses to ``root``; ends when the input is used up.

    A micro-batch that runs again writes the same folder again. ``process`` gets the
    written rows of each batch, for the transforms that follow.
    """

    def append(batch: DataFrame, number: int) -> None:
        write_snapshot(to_downloads(batch), root, LOG, number)
        if process:
            process(read_parts(batch.sparkSession, root, LOG, [number], TABLE), number)

    return (
        stream.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def current_downloads(spark: SparkSession, root: str, keep: int = 3) -> DataFrame:
    """The table with everything appended since its last compaction."""
    done = complete_snapshots(spark, root, TABLE)
    pending = [n for n in complete_snapshots(spark, root, LOG) if not done or n > done[-1]]
    table = read_snapshot(spark, root, TABLE)
    return merge_downloads(table, read_parts(spark, root, LOG, pending, TABLE), keep) if pending else table


def compact(spark: SparkSession, root: str, keep: int = 3) -> None:
    """Fold all appended rows into a new snapshot, numbered by the last batch it holds."""
    batches = complete_snapshots(spark, root, LOG)
    if batches:
        write_snapshot(current_downloads(spark, root, keep), root, TABLE, batches[-1])
