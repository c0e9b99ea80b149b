"""Mixing sources to target weights, with built-in functions only.

1. Words are counted per document and summed per source; partial sums leave the tasks, so a
   source that holds most rows is no heavier than others.
2. A step per round over the table of sources (one row each) finds the level at which the
   shares by weight, each held at its bound, give the size of the mixture.
3. A source's rate is its target over its size. Each document is emitted floor(rate) times
   and once more with the fraction as probability, drawn from a hash of its id and text.
   Rates meet the documents by source; no order, window or group of documents is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.columns import SPACES, free_name
from corpusflow.llm.numbering import numbered
from corpusflow.session import materialize

#: A word and the white space behind it.
_WORD = r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"
#: Range of a draw: 13 hexadecimal digits, which a double holds exactly.
_DRAWS = float(1 << 52)


def word_count(text: Column) -> Column:
    """Runs of characters that are not white space; null has none. The count builds no array of words."""
    marks = F.regexp_replace(F.btrim(text, F.lit(SPACES)), _WORD, "x")
    return F.coalesce(F.length(marks), F.lit(0)).cast("long")


def draw(doc: Column, text: Column, seed: int) -> Column:
    """A number from 0 up to but not including 1, the same in every run."""
    told = F.concat_ws(":", F.lit(str(seed)), F.coalesce(doc.cast("string"), F.lit("")), F.md5(F.encode(F.coalesce(text, F.lit("")), "UTF-8")))
    return F.conv(F.substring(F.md5(F.encode(told, "UTF-8")), 1, 13), 16, 10).cast("long") / F.lit(_DRAWS)


def _whole(number: int) -> Column:
    return F.lit(str(number)).cast("decimal(38,0)")


def _level(sources: DataFrame, percent: int, most: int) -> tuple[int, int]:
    """What a unit of weight gets, in hundredths of words, as numerator and denominator; denominator 0 where all are at their bound.

    Sources above their bound are held at it and the rest is shared anew, until none is above. These are
    Newton's steps on a concave sum of lines: few rounds, each of which brings one row to the driver.
    """
    bound = (F.col("source_size") * (100 * most)).cast("decimal(38,0)")
    first = sources.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    want = percent * (first["size"] or 0)
    level = want, first["weight"] or 0
    while level[1]:
        above = bound * _whole(level[1]) > F.col("weight") * _whole(level[0])
        held, free = F.sum(F.when(~above, bound)), F.sum(F.when(above, F.col("weight")))
        found = sources.agg(held.alias("held"), free.alias("free")).first()
        # A source exactly at its bound may count on either side.
        fresh = want - int(found["held"] or 0), found["free"] or 0
        if fresh == level or fresh[0] * level[1] == level[0] * fresh[1]:
            break
        level = fresh
    return level


def source_targets(
    docs: DataFrame, text: str = "text", source: str = "source", weights: Sequence[int] = (5, 2, 1), percent: int = 150, most: int = 2
) -> DataFrame:
    """A row for each source: source, source_size (words), weight, target (words, double), rate.

    Sources in order of their code points, null last, take the weights in turn. The targets share percent of all
    words by weight; a target stops at most times its source's size and the excess is shared
    by weight among the others. If all stop, the mixture stays smaller. A source without words has target and rate 0.
    """
    sizes = docs.select(F.col(source).alias("source"), word_count(F.col(text)).alias("n")).groupBy("source").agg(F.sum("n").alias("source_size"))
    cycle = F.array([F.lit(w) for w in weights])
    weight = F.element_at(cycle, (F.col("place") % len(weights) + 1).cast("int"))
    sources = numbered(sizes, [F.col("source").asc_nulls_last()], "sources").select("source", "source_size", weight.alias("weight"))
    words, parts = _level(sources, percent, most)
    bound = F.col("source_size") * most
    share = (F.col("weight") * _whole(words)).cast("double") / F.lit(100.0 * parts) if parts else bound.cast("double")
    target = F.least(share, bound.cast("double"))
    rate = F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(F.lit(0.0))
    return sources.withColumn("target", target).withColumn("rate", rate)


def repetitions(
    docs: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = (5, 2, 1),
    percent: int = 150,
    most: int = 2,
    seed: int = 0,
) -> DataFrame:
    """All rows and columns of docs, plus source_size, target and rate of the source, and copies of the document in the mixture.

    copies is floor(rate), plus one where the draw of the document is below the fraction; it is at most `most`.

    Null text counts as empty: no words, but copies like any other. Null ids are drawn by text alone. Rows that
    share id and text share a draw. The null source is a source of its own. Columns of docs with one
    of the four names, in any case, are replaced. No rows give no rows.
    """
    added = ["source_size", "target", "rate", "copies"]
    of = free_name(docs, "_source")
    targets = materialize(source_targets(docs, text, source, weights, percent, most), "mixing_targets")
    rates = targets.select(F.col("source").alias(of), *added[:3])
    joined = docs.drop(*added).join(rates, F.col(f"`{source}`").eqNullSafe(F.col(of))).drop(of)
    whole = F.floor("rate")
    more = draw(F.col(f"`{doc}`"), F.col(f"`{text}`"), seed) < F.col("rate") - whole
    return joined.withColumn("copies", (whole + more.cast("long")).cast("long"))


def mixed(docs: DataFrame, *args, **options) -> DataFrame:
    """The mixture: rows of docs as often as repetitions says, with all columns and copy, from 1. A column called copy is replaced."""
    rows = repetitions(docs, *args, **options).drop("copy")
    return rows.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop(
        "source_size", "target", "rate", "copies"
    )
