"""Time stamps: parsing at the edges in, formatting at the edges out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

POST_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"
UTC_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
OFFSET_FORMAT = "yyyy-MM-dd'T'HH:mm:ssXXX"
SQL_FORMAT = "yyyy-MM-dd HH:mm:ss"


def parse_post_time(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit(POST_FORMAT))


def parse_stored_time(text: Column) -> Column:
    """UTC, SQL and offset notations; null for anything else."""
    return F.coalesce(
        F.try_to_timestamp(text, F.lit(UTC_FORMAT)),
        F.try_to_timestamp(text, F.lit(SQL_FORMAT)),
        F.try_to_timestamp(text, F.lit(OFFSET_FORMAT)),
    )


def stored_time_error(text: Column) -> Column:
    return F.when(parse_stored_time(text).isNull(), "ErrUnsupportedTimestampFormat")


def format_utc(ts: Column) -> Column:
    return F.date_format(ts, UTC_FORMAT)
