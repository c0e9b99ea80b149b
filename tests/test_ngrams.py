"""Languages by character n-grams."""

from collections import Counter

from pyspark.sql import functions as F

from corpusflow.functions import language
from corpusflow.operators import ngrams


def plain_grams(text):
    import re

    counts = Counter()
    for word in re.findall(r"[^\W\d_]+", text.lower()):
        b = f" {word} "
        counts.update(g for n in (1, 2, 3) for i in range(len(b) - n + 1) if (g := b[i : i + n]) != " ")
    return counts


def test_counts_and_ranks(spark):
    texts = ["The cat, the Hat!", "été 12 ete", "", None, "x" * 20_000, "a"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {}
    for r in ngrams.gram_counts(df, ["i"], "t").collect():
        got.setdefault(r.i, Counter())[r.gram] = r.n
    assert got == {i: plain_grams(t) for i, t in enumerate(texts) if t}
    ranks = ngrams.learn_profiles(df.withColumn("l", F.when(F.col("i") < 2, "a")), "t", "l", 5).collect()
    want = sorted((plain_grams(texts[0]) + plain_grams(texts[1])).items(), key=lambda x: (-x[1], x[0].encode()))[:5]
    assert sorted((r["rank"], r["gram"]) for r in ranks) == list(enumerate(g for g, _ in want)) and {r["language"] for r in ranks} == {"a"}


def test_detection(spark):
    known = [("en", "the house and the garden with the old tree"), ("de", "das haus und der garten mit dem alten baum"), (None, "zzz")]
    profiles = ngrams.learn_profiles(spark.createDataFrame(known, "l string, t string"), "t", "l")
    texts = ["the tree", "der baum", None, "", "123", "жжж", "The Garden " * 5000]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: (r.language, r.distance) for r in ngrams.detect(df, "i", "t", profiles).collect()}
    assert [got[i][0] for i in range(7)] == ["en", "de", None, None, None, "de", "en"]
    assert got[5][1] == 300 * len(plain_grams("жжж"))
    assert ngrams.detect(df.limit(0), "i", "t", profiles).count() == 0


def test_detection_moves_no_words(spark):
    """A text's words and n-grams stay in its row; repeated keys count as one text."""
    known = [("en", "the house and the garden with the old tree"), ("de", "das haus und der garten mit dem alten baum")]
    profiles = ngrams.learn_profiles(spark.createDataFrame(known, "l string, t string"), "t", "l").localCheckpoint()
    rows = [(1, "the tree"), (1, "The garden"), (2, "der baum"), (2, "der baum"), (3, None), (3, "der"), (None, "the")]
    df = spark.createDataFrame(rows, "i int, t string").localCheckpoint()
    found = ngrams.detect(df, "i", "t", profiles)
    merged = ngrams.detect(spark.createDataFrame([(1, "the tree The garden"), (2, "der baum der baum"), (3, "der")], "i int, t string"), "i", "t", profiles)
    want = {tuple(r) for r in merged.collect()}
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, [r for r in want for _ in range(2)] + [(None, None, None)]))
    # Exchanged are rows of texts and languages, none of n-grams or words.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode(" not in plan
    for text, ranks in {"Tree, été été!": 300, "": 300, "a b a": 2}.items():
        got = spark.createDataFrame([(text,)], "t string").select(ngrams.text_ranks(F.col("t"), ranks)).first()[0]
        want = sorted(plain_grams(text).items(), key=lambda x: (-x[1], x[0].encode()))[:ranks]
        assert got == ([g for g, _ in want] or None)


def test_better_than_word_lists(spark):
    """On texts the profiles have not seen, cut to their first words."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    docs = docs.withColumn("t", F.array_join(F.slice(F.split("text", " "), 1, 8), " "))
    profiles = ngrams.learn_profiles(docs.where("doc_id % 5 <> 0"), "text", "lang")
    held = docs.where("doc_id % 5 = 0")
    ours = ngrams.detect(held, "doc_id", "t", profiles).join(held.select("doc_id", "lang"), "doc_id")
    lists = language.with_profile(held, "t")
    right = ours.where("language = lang").count(), lists.where("detected = lang").count()
    assert right[0] > right[1] and right[0] >= 0.95 * held.count()


def test_ranks_of_many_texts_at_a_time(spark, monkeypatch):
    """Some texts at a time share the n-grams of their words; no array expression makes an object of each n-gram."""
    import random

    import pyarrow as pa

    draw = random.Random(5)
    words = ["a", "été", "haus", "жук", "𝒳y", "x" * 3000, "der", "ab", "ba"]
    texts = [" ".join(draw.choices(words, k=draw.choice([0, 1, 5, 200]))) for _ in range(400)] + [None, "", "12"]
    want = [[g for g, _ in sorted(plain_grams(t or "").items(), key=lambda x: (-x[1], x[0].encode()))[:40]] or None for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").coalesce(1).select("i", ngrams.text_ranks(F.col("t"), 40).alias("r"))
    assert "array_sort" not in (plan := df._jdf.queryExecution().executedPlan().toString()) and "ArrowEvalPython" in plan and "lambda" not in plan
    assert [r.r for r in df.orderBy("i").collect()] == want
    lists = pa.array([None, [], ["ab"], ["ab", "ba", "ab"]], pa.list_(pa.string()))
    monkeypatch.setattr(ngrams, "_AT_A_TIME", 2)
    import numpy as np

    assert list(ngrams._slices(np.array([0, 0, 1, 3, 1, 1, 1]))) == [(0, 3), (3, 4), (4, 6), (6, 7)] and not list(ngrams._slices(np.array([], int)))
    assert ngrams._ranked_texts(lists.slice(1), 2).to_pylist() == [None, [" a", " ab"], ["a", "b"]]
    cut = ngrams._word_grams(pa.array(["ab", "жж", "c"])).to_pylist()
    assert [sorted(c) for c in cut] == [sorted(plain_grams(w).elements()) for w in ("ab", "жж", "c")]
    assert ngrams._word_grams(pa.array([], pa.string())).to_pylist() == []
    plan = ngrams.gram_counts(spark.createDataFrame([("a", "b c")], "l string, t string"), ["l"], "t")._jdf.queryExecution().executedPlan().toString()
    # From the end of the job to its begin: words are counted, in both steps, before they are cut.
    assert plan.index("ArrowEvalPython") < plan.index("count(1)")
