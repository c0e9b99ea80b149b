"""Small column helpers of the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: The characters that the word and line rules count as white space.
SPACES = " \t\n\x0b\x0c\r"


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def free_name(df: DataFrame, name: str) -> str:
    """A column name that df does not have in any case, as Spark tells names apart."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name
