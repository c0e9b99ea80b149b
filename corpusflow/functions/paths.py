"""File paths inside repository URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusflow import fixed


def file_path(url: Column) -> Column:
    """Everything after ``blob/<one segment>``; '' where there is no such part."""
    parts = F.split(url, "/")
    at = F.array_position(parts, "blob").cast("int")
    rest = F.slice(parts, at + 2, F.greatest(F.size(parts) - at - 1, F.lit(0)))
    found = (F.size(parts) >= 7) & (at > 0) & (at + 1 < F.size(parts))
    return F.when(found, F.array_join(rest, "/")).otherwise("")


def extension(path: Column) -> Column:
    """From the last dot of the last segment, dot included; '' without a dot."""
    return F.regexp_extract(path, r"(\.[^./]*)$", 1)


def base_name(path: Column) -> Column:
    name = F.element_at(F.split(F.regexp_replace(path, "/+$", ""), "/"), -1)
    return F.when(path == "", ".").otherwise(name)


def directory(path: Column) -> Column:
    """Path without its last segment; null at the top level."""
    found = F.regexp_extract(path, r"^(.*)/[^/]*$", 1)
    return F.when(found != "", found)


def owner(url: Column) -> Column:
    return _part(url, 3)


def repo(url: Column) -> Column:
    return _part(url, 4)


def branch(url: Column) -> Column:
    """All segments between ``blob`` and the file name, directories included."""
    parts = F.split(url, "/")
    middle = F.slice(parts, 7, F.greatest(F.size(parts) - 7, F.lit(0)))
    found = (F.size(parts) >= 7) & (F.get(parts, F.lit(5)) == "blob") & (F.size(middle) > 0)
    return F.when(found, F.array_join(middle, "/"))


def stored_format(ext: Column) -> Column:
    return F.when(ext.isin(".yaml", ".yml"), "yaml").otherwise("json")


def is_excluded(path: Column, exclusions: list[str] | None = None, match: str = "substring") -> Column:
    """``substring`` hits anywhere in the path, ``segment`` whole path segments only."""
    words = fixed.EXCLUDED_SUBSTRINGS if exclusions is None else exclusions
    if match == "segment":
        return F.arrays_overlap(F.split(path, "/"), F.array(*[F.lit(w) for w in words]).cast("array<string>"))
    hit = F.lit(False)
    for word in words:
        hit = hit | F.contains(path, F.lit(word))
    return hit


def is_importable(path: Column, extensions: list[str] | None = None) -> Column:
    wanted = fixed.IMPORTABLE_EXTENSIONS if extensions is None else extensions
    return F.lower(extension(path)).isin([e.lower() for e in wanted])


def language_label(ext: Column) -> Column:
    """Language of an extension, null when it is not a code extension."""
    table = F.create_map(*[F.lit(x) for pair in fixed.LANGUAGE_BY_EXTENSION.items() for x in pair])
    return table[ext]


def code_language(ext: Column) -> Column:
    """Label as far as the chunk table stores it, '' for other code, null for text."""
    label = language_label(ext)
    return F.when(label.isin(fixed.STORED_CODE_LANGUAGES), label).when(label.isNotNull(), "")


def _part(url: Column, index: int) -> Column:
    parts = F.split(url, "/")
    return F.when(F.size(parts) >= 5, F.get(parts, F.lit(index)))
