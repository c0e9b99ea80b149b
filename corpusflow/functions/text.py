"""Small text measures and clean-ups."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LINK_PATTERN = r"\[([^\]]*)\]\([^\)]*\)"
# White space that trimming removes: ASCII controls, next line, no-break and Unicode spaces.
TRIMMED = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def link_count(markdown: Column) -> Column:
    return F.regexp_count(markdown, F.lit(LINK_PATTERN))


def byte_size(text: Column) -> Column:
    return F.octet_length(text)


def line_count(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1


def trimmed(text: Column) -> Column:
    return F.trim(text, F.lit(TRIMMED))


def embedding_input(body: Column) -> Column:
    """Line feeds become spaces, the ends are trimmed, inner runs stay."""
    return trimmed(F.replace(body, F.lit("\n"), F.lit(" ")))


def is_embeddable(body: Column) -> Column:
    return body.isNotNull() & (body != "")


def fenced(body: Column, label: Column) -> Column:
    return F.concat(F.lit("```"), F.coalesce(label, F.lit("")), F.lit("\n"), body, F.lit("\n```"))


def decoded_base64(body: Column) -> Column:
    """Padded base64, line ends allowed, as UTF-8; null when the text is anything else."""
    packed = F.translate(body, "\r\n", "")
    valid = F.rlike(packed, F.lit("^[A-Za-z0-9+/]*={0,2}$")) & (F.length(packed) % 4 == 0)
    return F.when(valid, F.try_to_binary(packed, F.lit("base64")).cast("string"))
