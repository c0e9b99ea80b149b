"""Whole numbers for rows in an order, without putting all rows in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.session import materialize


def numbered(rows: DataFrame, order: list[Column], purpose: str, name: str = "place") -> DataFrame:
    """rows with a number from 0 in the given order.

    Rows stay dealt by range and are written once; only the counts of the ranges, one
    row for each, are put in one order. Columns called _range or _before are not allowed.
    """
    dealt = materialize(rows.orderBy(*order).withColumn(name, F.monotonically_increasing_id()), purpose)
    part, inside = F.shiftright(name, 33), F.col(name).bitwiseAND(F.lit((1 << 33) - 1))
    before = F.sum("n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    counts = dealt.groupBy(part.alias("_range")).agg(F.count("*").alias("n"))
    counts = counts.select("_range", F.coalesce(before, F.lit(0)).alias("_before"))
    return dealt.join(F.broadcast(counts), part == F.col("_range")).withColumn(name, inside + F.col("_before")).drop("_range", "_before")
