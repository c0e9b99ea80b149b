"""What a run did, per source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def summary(results: DataFrame, group: str, sequence: str, item: str) -> DataFrame:
    """Totals, failures, first error, last successful item and the verdict per group.

    Partial failure still succeeds, flagged; only a group without any success fails.
    """
    failed = F.col("error").isNotNull()
    outcome = (
        F.when(F.col("ok") == 0, "failed").when(F.col("failed") > 0, "ErrImportCompleted").otherwise("ok")
    )
    return (
        results.groupBy(group)
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.count_if(failed).alias("failed"),
            F.count_if(~failed).alias("ok"),
            F.min(F.when(failed, F.struct(F.col(sequence).alias("at"), F.col("error").alias("value")))).alias("_first"),
            F.max(F.when(~failed, F.struct(F.col(sequence).alias("at"), F.col(item).alias("value")))).alias("_last"),
        )
        .select(
            group,
            "total",
            "failed",
            "ok",
            F.col("_first.value").alias("first_error"),
            F.col("_last.value").alias("last_ok"),
            outcome.alias("outcome"),
        )
    )
