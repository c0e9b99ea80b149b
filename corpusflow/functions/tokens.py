"""Lossless tokens: joining them gives back the text, byte for byte."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusflow import fixed

# Word with one leading mark, up to three digits, run of marks, run of white space.
# Every character belongs to exactly one alternative. The white-space class is
# spelled out and nothing looks ahead, so Java and RE2 cut at the same places.
TOKEN_PATTERN = (
    r"[^\r\n\p{L}\p{N}]?\p{L}+|\p{N}{1,3}| ?[^ \t\n\r\f\x0B\p{L}\p{N}]+[\r\n]*|[ \t\n\r\f\x0B]+"
)


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), F.lit(0))


#: Tokens that counting takes at a time.
_RUN = 32


def token_runs(text: Column, size: int) -> Column:
    """The text in runs of so many tokens, the last one of what is left, as one match each.

    The quantifier is possessive: it takes tokens as a search would and keeps no way back, so runs may be long.
    """
    return F.regexp_extract_all(text, F.lit(f"(?:{TOKEN_PATTERN}){{1,{size}}}+"), F.lit(0))


def token_marks(text: Column) -> Column:
    """Number of tokens. Every character is part of one, so a mark for each counts them, without an array of tokens."""
    return F.length(F.regexp_replace(text, F.lit(TOKEN_PATTERN), F.lit("x")))


def token_count(text: Column) -> Column:
    """Number of tokens: whole runs count as such, only the last one is looked into."""
    runs = token_runs(text, _RUN)
    last = token_marks(F.get(runs, F.size(runs) - 1))
    # An empty text has no run, and no last one.
    return (F.size(runs) - 1) * _RUN + F.coalesce(last, F.lit(_RUN))


def resolve_tokenizer(name: str | None) -> str:
    """Known tokenizer of that name, any case; the default otherwise."""
    lowered = (name or "").lower()
    return lowered if lowered in fixed.TOKENIZERS else fixed.DEFAULT_TOKENIZER
