"""Embedding vectors: text forms and the column a dimension belongs to."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusflow import fixed


def to_text(vector: Column) -> Column:
    return F.to_json(vector)


def to_bracket_text(vector: Column) -> Column:
    """The doubly bracketed, space-separated notation of stored vectors."""
    return F.concat(F.lit("[["), F.array_join(vector.cast("array<string>"), " "), F.lit("]]"))


def from_text(text: Column) -> Column:
    """Read either notation."""
    inner = F.trim(F.regexp_replace(text, r"[\[\]]", ""))
    return F.when(inner == "", F.array().cast("array<float>")).otherwise(
        F.transform(F.split(inner, "[ ,]+"), lambda x: x.cast("float"))
    )


def by_dimension(vector: Column, dims: dict[int, str] | None = None) -> dict[str, Column]:
    """One column per stored dimension; a vector sits in the column of its size."""
    table = fixed.EMBEDDING_COLUMNS if dims is None else dims
    return {name: F.when(F.size(vector) == size, vector) for size, name in table.items()}


def dimension_error(vector: Column, dims: dict[int, str] | None = None) -> Column:
    table = fixed.EMBEDDING_COLUMNS if dims is None else dims
    return F.when(vector.isNull(), "ErrNoEmbeddingVector").when(
        ~F.size(vector).isin(list(table)), "ErrUnsupportedEmbeddingDim"
    )
