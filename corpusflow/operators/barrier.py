"""Costly columns that many expressions read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that the optimizer will not copy into the expressions that read them.

    A filter on something derived from a column is moved below the projection and
    takes the column's expression along, once per mention. It does not move through
    an explode, here of a one-row array.
    """
    fields = [column.alias(name) for name, column in columns.items()]
    return df.select("*", F.inline(F.array(F.struct(*fields))))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` reads it: the one element of an array."""
    return F.element_at(F.transform(F.array(value), use), 1)
