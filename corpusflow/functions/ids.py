"""Row ids that are the same on every retry and every rerun."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNIT_SEPARATOR = "\x1f"


def stable_id(*parts: Column | str) -> Column:
    """SHA-256 of the natural key; a null part counts as missing."""
    return F.sha2(F.concat_ws(UNIT_SEPARATOR, *[_as_text(p) for p in parts]), 256)


def _as_text(part: Column | str) -> Column:
    return (F.col(part) if isinstance(part, str) else part).cast("string")
