"""Line deduplication over a corpus, with built-in functions only.

Lines that many documents hold (navigation, licences, quotations) stay in one
document and leave all others. Only hashes, ids and positions are shuffled by
line; the texts move once, to meet the positions of what they lose.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.columns import SPACES, free_name, lower_ascii


def line_key(line: Column) -> Column:
    """What two lines must share to count as the same."""
    return lower_ascii(F.btrim(line, F.lit(SPACES)))


def _hashed_lines(docs: DataFrame, doc: str, text: str, min_chars: int) -> DataFrame:
    """A row for each line long enough to be dropped: document, text hash, position, 128-bit key hash."""
    lines = docs.select(
        F.col(doc).alias("doc"),
        F.xxhash64(text).alias("version"),
        F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)).alias("pos", "line"),
    ).select("doc", "version", "pos", line_key(F.col("line")).alias("key"))
    return lines.where(F.length("key") >= min_chars).select(
        "doc", "version", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")
    )


def dropped_positions(
    docs: DataFrame, doc: str = "doc_id", text: str = "text", min_chars: int = 20, min_docs: int = 3
) -> DataFrame:
    """doc, version (hash of the text), dropped: sorted positions of the lines that this text loses."""
    lines = _hashed_lines(docs, doc, text, min_chars)
    common = (
        lines.groupBy("h1", "h2")
        .agg(F.count_distinct(F.struct("doc")).alias("docs"), F.max("doc").alias("keeper"))
        .where(F.col("docs") >= min_docs)
        .select("h1", "h2", "keeper")
    )
    return (
        lines.join(common, ["h1", "h2"])
        .where(~F.col("doc").eqNullSafe(F.col("keeper")))
        .groupBy("doc", "version")
        .agg(F.sort_array(F.collect_set("pos")).alias("dropped"))
    )


def _without(lines: Column, dropped: Column) -> Column:
    """The lines between dropped positions, in time linear in both."""
    cuts = F.concat(F.array(F.lit(-1)), dropped, F.array(F.size(lines)))

    def between(i: Column) -> Column:
        start = F.element_at(cuts, i) + 2
        return F.slice(lines, start, F.element_at(cuts, i + 1) - start + 1)

    return F.flatten(F.transform(F.sequence(F.lit(1), F.size(dropped) + 1), between))


def dedup_lines(
    docs: DataFrame, doc: str = "doc_id", text: str = "text", min_chars: int = 20, min_docs: int = 3
) -> DataFrame:
    """All rows and columns of docs, text without repeated lines, plus n_lines and n_dropped.

    A line's key is the line without white space at both ends and with A-Z
    lower-cased. Keys of at least min_chars code points that occur in at least
    min_docs documents lose all their lines except in the largest id holding them.

    Null text counts as empty, which is one empty line. Rows with a null id are
    one document, smaller than all others. Rows that share an id are one
    document when documents are counted, and each row keeps its own text.
    Columns of docs called n_lines or n_dropped, in any case, are replaced; all others stay, whatever
    their names. No rows give no rows.
    """
    of, version, dropped = (free_name(docs, n) for n in ("_doc", "_version", "_dropped"))
    found = dropped_positions(docs, doc, text, min_chars, min_docs).toDF(of, version, dropped)
    whole = F.coalesce(F.col(text), F.lit(""))
    joined = docs.join(
        found.hint("shuffle_hash"),
        F.col(doc).eqNullSafe(F.col(of)) & (F.xxhash64(text) == F.col(version)),
        "left",
    )
    kept = F.array_join(_without(F.split(whole, "\n", -1), F.col(dropped)), "\n")
    return joined.withColumns(
        {
            "n_lines": (F.octet_length(whole) - F.octet_length(F.replace(whole, F.lit("\n"), F.lit(""))) + 1).cast("long"),
            "n_dropped": F.coalesce(F.size(dropped), F.lit(0)).cast("long"),
            text: F.when(F.col(dropped).isNull(), whole).otherwise(kept),
        }
    ).drop(of, version, dropped)
