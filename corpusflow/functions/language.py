"""Natural language of a text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow import fixed
from corpusflow.operators.barrier import bound

# Frequent short words per language, for the word-count detector.
STOP_WORDS = {
    "english": ["the", "and", "of", "to", "in", "is", "that", "for", "with", "was", "this", "are", "from", "it"],
    "french": ["le", "la", "les", "des", "et", "une", "que", "qui", "dans", "pour", "est", "avec", "du", "au"],
    "german": ["der", "die", "das", "und", "ist", "nicht", "mit", "für", "ein", "eine", "auf", "sich", "von", "den"],
    "spanish": ["el", "los", "las", "y", "que", "por", "con", "para", "una", "es", "del", "se", "no", "como"],
}
WORD_PATTERN = r"\p{L}+"


def _hits(lowered: Column) -> Column:
    return reduce(
        lambda a, b: a + b, [F.contains(lowered, F.lit(word)).cast("int") for word in fixed.FRENCH_INDICATORS]
    )


def french_hits(text: Column) -> Column:
    return bound(F.lower(text), _hits)


#: Characters of a text that are searched first.
_START = 2048


def _said_once(lowered: Column) -> Column:
    """Every word that a space follows once, with that space: it holds an indicator if the text does, and is short.

    Indicators are the end of a word and its space, so no two words that come together here make one.
    """
    return bound(
        F.split(lowered, " ", -1),
        lambda parts: F.concat(F.array_join(F.array_distinct(F.slice(parts, F.lit(1), F.size(parts) - 1)), " "), F.lit(" ")),
    )


def heuristic(text: Column) -> Column:
    """``fr`` when at least three French indicators occur, else ``en``.

    What occurs in the start of a text occurs in it, so the rest is lowered and searched only where the start has too few.
    Only the distinct words are searched for the indicators.
    """

    def enough(part: Column) -> Column:
        return bound(_said_once(F.lower(part)), _hits) >= fixed.FRENCH_THRESHOLD

    return F.when(F.exists(F.array(F.left(text, F.lit(_START)), text), enough), "fr").otherwise("en")


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_PATTERN), F.lit(0))


def profile_scores(word_array: Column) -> Column:
    """Stop-word hits per language as an array of (score, language)."""

    def score(name: str) -> Column:
        hits = F.filter(word_array, lambda word: word.isin(STOP_WORDS[name]))
        return F.struct(F.size(hits).alias("score"), F.lit(name).alias("language"))

    return F.array(*[score(name) for name in STOP_WORDS])


def with_profile(df: DataFrame, text: str, name: str = "detected", scores: str = "scores") -> DataFrame:
    """Add the language name with most stop-word hits and all scores.

    Null without any hit; of equal scores the last name in order wins. Words and
    scores are columns of their own so that each is computed once per row.
    """
    best = F.array_max(scores)
    return (
        df.withColumn("_words", words(F.col(text)))
        .withColumn(scores, profile_scores(F.col("_words")))
        .drop("_words")
        .withColumn(name, F.when(best["score"] > 0, best["language"]))
    )
