"""Language by character n-grams: rank profiles learned from texts, and the distance of a text's own ranks.

A language's profile is its most frequent n-grams in order. A text's distance from it sums, over the text's own most
frequent n-grams, how far each is out of place; one that the profile lacks counts as out of it by the whole
profile. Profiles are partial aggregates: words are counted before they are cut into n-grams, so each
task sends its distinct words on. A text's own ranks are made where it is, for some texts at a time in Python, so that neither its words nor
its n-grams are shuffled; array expressions would make an object of every n-gram of every word and sort them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.functions.language import words
from corpusflow.operators.barrier import computed_once
from corpusflow.workers import ship_by_value, trim

#: N-grams of a profile, and the lengths of an n-gram.
PROFILE, SIZES = 300, (1, 2, 3)
#: Words, and texts, that are worked on at a time.
_AT_A_TIME, _TEXTS = 1 << 16, 128
#: Bits of a character; as many characters as an n-gram has fit into a number.
_BITS = 21


def _numbered(words: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The n-grams of some words between blanks; those of one character leave the blanks out.

    Given are the distinct ones in the order of their bytes, the places in there of those of every word, word after word,
    and where each word's places end. An n-gram is a number, its characters from the left: numbers have the order of the texts.
    """
    chars = np.frombuffer("".join(f" {word} " for word in words).encode("utf-32-le"), np.uint32).astype(np.int64)
    of = np.repeat(np.arange(len(words)), [len(word) + 2 for word in words])
    gram, codes, owners = np.zeros(len(chars), np.int64), [], []
    for n in range(max(SIZES)):
        there = len(chars) - n
        gram = gram[:there] | chars[n:] << (_BITS * (max(SIZES) - 1 - n))
        inside = of[:there] == of[n:] if n else chars != ord(" ")
        codes.append(gram[inside])
        owners.append(of[:there][inside])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    found, present = pd.factorize(np.concatenate(codes)[order])
    ranked = np.argsort(present)
    place = np.empty_like(ranked)
    place[ranked] = np.arange(len(ranked))
    shifts = [_BITS * n for n in reversed(range(max(SIZES)))]
    grams = ["".join(chr(c) for s in shifts if (c := code >> s & (1 << _BITS) - 1)) for code in present[ranked].tolist()]
    return pa.array(grams, pa.string()), place[found], np.cumsum(np.bincount(owner, minlength=len(words)))


def _word_grams(words: pa.Array) -> pa.Array:
    """The n-grams of each of some words."""
    parts = [pa.array([], pa.list_(pa.string()))]
    for begin in range(0, len(words), _AT_A_TIME):
        grams, places, ends = _numbered(words.slice(begin, _AT_A_TIME).to_pylist())
        parts.append(pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), grams.take(pa.array(places))))
    return pa.concat_arrays(parts)


def _grams(word: Column) -> Column:
    """The n-grams of a word, which is no null."""

    @F.arrow_udf("array<string>")
    def cut(words: pa.Array) -> pa.Array:
        return _word_grams(words)

    return cut(word)


def gram_counts(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """keys, gram, n: how often the texts of a key hold an n-gram. Letters only, in lower case."""
    said = df.select(*keys, F.explode(words(F.col(text))).alias("word")).groupBy(*keys, "word").agg(F.count("*").alias("times"))
    # Else words would be cut where they are read, before they are counted.
    said = computed_once(said, {"_word": F.col("word")})
    cut = said.select(*keys, "times", _grams(F.col("_word")).alias("_grams")).select(*keys, F.explode("_grams").alias("gram"), "times")
    return cut.groupBy(*keys, "gram").agg(F.sum("times").alias("n"))


def _ranked(counts: DataFrame, keys: list[str], most: int) -> DataFrame:
    """keys, gram, rank from 0: the most frequent of each key, ties in order of their bytes."""
    first = Window.partitionBy(*keys).orderBy(F.desc("n"), "gram")
    return counts.withColumn("rank", F.row_number().over(first) - 1).where(F.col("rank") < most).select(*keys, "gram", "rank")


def _slices(lengths: np.ndarray) -> Iterator[tuple[int, int]]:
    """Begin and end of consecutive texts of so many words together, or of one text that has more."""
    begin, held = 0, 0
    for at, length in enumerate(lengths.tolist()):
        if at > begin and (held + length > _AT_A_TIME or at - begin == _TEXTS):
            yield begin, at
            begin, held = at, 0
        held += length
    if begin < len(lengths):
        yield begin, len(lengths)


def _ranked_texts(words: pa.ListArray, most: int) -> pa.Array:
    """The most frequent n-grams of some texts, given their words.

    N-grams are cut once for each distinct word of all the texts and numbered in the order of their bytes; what a text
    holds of them are sums over its own distinct words.
    """
    lengths = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False)
    coded = words.flatten().dictionary_encode()
    words_there = max(1, len(coded.dictionary))
    grams, numbers, ends = _numbered(coded.dictionary.to_pylist())
    firsts = np.append(0, ends)
    # Distinct words of each text, and how often it has them.
    text = np.repeat(np.arange(len(lengths)), lengths)
    pairs, times = np.unique(text * words_there + coded.indices.to_numpy(), return_counts=True)
    text, word = np.divmod(pairs, words_there)
    bounds, taken, ranked = np.searchsorted(text, np.arange(len(lengths) + 1)), [], []
    for begin, end in zip(bounds[:-1], bounds[1:], strict=True):
        own = word[begin:end]
        sizes = ends[own] - firsts[own]
        places = np.arange(sizes.sum()) + np.repeat(ends[own] - np.cumsum(sizes), sizes)
        counts = np.bincount(numbers[places], np.repeat(times[begin:end], sizes), len(grams))
        held = np.flatnonzero(counts)
        ranked.append(held[np.argsort(-counts[held], kind="stable")[:most]])
        taken.append(len(ranked[-1]))
    offsets = pa.array(np.append(0, np.cumsum(taken)), pa.int32())
    return pa.ListArray.from_arrays(offsets, grams.take(pa.array(np.concatenate(ranked))), mask=pa.array(np.array(taken) == 0))


def text_ranks(text: Column, most: int = PROFILE) -> Column:
    """The most frequent n-grams of a text in order, ties in order of their bytes; null for a text without a letter."""

    @F.arrow_udf("array<string>")
    def ranks(words: pa.Array) -> pa.Array:
        lengths = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False)
        parts = [_ranked_texts(words.slice(begin, end - begin), most) for begin, end in _slices(lengths)]
        trim()
        return pa.concat_arrays([pa.array([], pa.list_(pa.string())), *parts])

    return ranks(words(text))


def learn_profiles(df: DataFrame, text: str, lang: str, most: int = PROFILE) -> DataFrame:
    """language, gram, rank: the profile of every language among the rows that have one."""
    known = df.where(F.col(lang).isNotNull()).select(F.col(lang).alias("language"), text)
    return _ranked(gram_counts(known, ["language"], text), ["language"], most)


def _one_text(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, text: the texts of a repeated key in one row; most have a single text, which stays where it is."""
    rows = df.select(key, text)
    repeated = rows.groupBy(key).agg(F.count("*").alias("_times")).where("_times > 1").select(key)
    joined = rows.join(repeated, key, "left_semi").groupBy(key).agg(F.array_join(F.collect_list(text), "\n").alias(text))
    return rows.join(repeated, key, "left_anti").unionByName(joined)


def detect(df: DataFrame, key: str, text: str, profiles: DataFrame, most: int = PROFILE) -> DataFrame:
    """key, language, distance: the language whose profile is nearest to each text; ties to the first in the alphabet.

    Both are null for texts without a letter and for a null key. Texts that share a key count as one. The profiles have
    ``most`` rows a language and are joined by n-gram, so a text meets few rows of them.
    """
    ranked = _one_text(df, key, text).withColumn("_grams", text_ranks(F.col(text), most))
    own = ranked.select(key, F.size("_grams").alias("_size"), F.posexplode_outer("_grams").alias("rank", "gram"))
    # An n-gram that a profile lacks is out of place by `most`; hits are counted as what they save of that.
    places = profiles.select("gram", F.col("language").alias("_language"), F.col("rank").alias("_place"))
    near = own.join(F.broadcast(places), "gram", "left")
    saved = near.groupBy(key, "_size", "_language").agg(F.sum(most - F.abs(F.col("rank") - F.col("_place"))).alias("_saved"))
    languages = profiles.select("language").distinct()
    # For texts that share nothing with any profile: the first language, at full distance.
    none = languages.agg(F.min("language").alias("language"))
    best = saved.groupBy(key, "_size").agg(
        F.min(F.when(F.col("_language").isNotNull(), F.struct((-F.col("_saved")).alias("less"), F.col("_language").alias("language")))).alias("best")
    )
    met = best.crossJoin(F.broadcast(none))  # one row
    found = met.select(
        key,
        F.when(F.col("_size") > 0, F.coalesce("best.language", "language")).alias("language"),
        F.when(F.col("_size") > 0, F.col("_size") * F.lit(most).cast("long") + F.coalesce("best.less", F.lit(0))).alias("distance"),
    )
    return df.select(key).join(found, key, "left")


ship_by_value(__name__)
