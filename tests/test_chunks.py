import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusflow.functions.tokens import token_count, tokens
from corpusflow.operators.chunks import broken_links, chunk_total, empty_texts, token_chunks
from corpusflow.options import ChunkOptions


def chunked(spark, texts, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "doc int, text string")
    return token_chunks(df, "doc", "text", ChunkOptions(**options)).orderBy("document_id", "pos").collect()


def naive(words, size, overlap):
    """Slices of ``size`` at steps of size minus overlap up to the first that reaches the end."""
    out, start = [], 0
    while True:
        out.append(words[start : start + size])
        if start + size >= len(words):
            return out
        start += size - overlap


def test_single_chunk_is_the_text(spark):
    for text in ["Hello", "   ", "!", "x" * 10000]:
        (row,) = chunked(spark, [text], max_tokens=8191)
        assert row.body == text and row.left_chunk_id is None and row.right_chunk_id is None
    (row,) = chunked(spark, ["Hello"], max_tokens=1)
    assert row.body == "Hello" and row.token_count == 1 and row.byte_size == 5


def test_other_tokenizer(spark):
    df = spark.createDataFrame([(1, "abcde")], "doc int, text string")
    made = token_chunks(df, "doc", "text", ChunkOptions(2, tokenizer="R50K_base"), tokenize=lambda c: F.split(c, ""))
    assert [(r.body, r.tokenizer) for r in made.orderBy("pos").collect()] == [
        ("ab", "r50k_base"), ("cd", "r50k_base"), ("e", "r50k_base"),
    ]


def test_bad_options():
    for bad in (dict(max_tokens=0), dict(max_tokens=-1), dict(max_tokens=5, overlap=5), dict(max_tokens=5, overlap=-1)):
        with pytest.raises(ValueError):
            ChunkOptions(**bad)
    with pytest.raises(ValueError, match="ErrNoChunkerRegistered"):
        ChunkOptions(strategy="by weight")


def test_empty_text_is_a_reject(spark):
    df = spark.createDataFrame([(1, ""), (2, None), (3, "x")], "doc int, text string")
    assert token_chunks(df, "doc", "text").count() == 1
    assert sorted((r.document_id, r.error) for r in empty_texts(df, "doc", "text").collect()) == [
        (1, "ErrContentEmpty"), (2, "ErrContentEmpty"),
    ]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(max_size=60), min_size=1, max_size=12), st.integers(1, 9), st.data())
def test_against_slices(spark, texts, size, data):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    overlap = data.draw(st.integers(0, size - 1))
    df = spark.createDataFrame(list(enumerate(texts)), "doc int, text string")
    words = {r.doc: r.t for r in df.select("doc", tokens(F.col("text")).alias("t")).collect()}
    rows = chunked(spark, texts, max_tokens=size, overlap=overlap)
    for doc, text in enumerate(texts):
        mine = [r for r in rows if r.document_id == doc]
        if text == "":
            assert mine == []
            continue
        expected = naive(words[doc], size, overlap)
        assert [r.body for r in mine] == ["".join(part) for part in expected]
        assert [r.token_count for r in mine] == [len(part) for part in expected]
        assert [r.right_chunk_id for r in mine[:-1]] == [r.id for r in mine[1:]]
        assert [r.left_chunk_id for r in mine[1:]] == [r.id for r in mine[:-1]]
        assert mine[0].left_chunk_id is None and mine[-1].right_chunk_id is None


def test_chunk_total(values):
    assert values([1, 100, 101, 180, 181], lambda c: chunk_total(c, 100, 20), "int") == [1, 1, 2, 2, 3]


def test_broken_links(spark):
    rows = [("a", None, "b"), ("b", "a", "c"), ("c", "x", None), ("d", None, "zz")]
    df = spark.createDataFrame(rows, "id string, left_chunk_id string, right_chunk_id string")
    assert sorted((r.id, r.side) for r in broken_links(df).collect()) == [("b", "right"), ("c", "left"), ("d", "right")]


def test_plan_has_no_shuffle_and_no_python(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    made = token_chunks(df, "doc_id", "text", ChunkOptions(100, 20))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    assert plan.count("regexp_extract_all") == 1
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_sections(spark):
    """Headings and packed sentences: lossless, linked, within the limit."""
    from corpusflow.operators.chunks import cut

    texts = [
        "intro line\n# One\nbody of one\n## Two\n#no heading\n### \nlast", "no heading at all", "# only", None, "",
        "First one. Second one! Third?\n\n\n\nNext paragraph is here. " + "very " * 40 + "long sentence. End.", "word " * 500,
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for strategy in ("heading", "recursive"):
        rows = cut(df, "i", "t", ChunkOptions(max_tokens=12, strategy=strategy)).orderBy("document_id", "pos").collect()
        for i, text in enumerate(texts):
            own = [r for r in rows if r.document_id == i]
            assert "".join(r.body for r in own) == (text or "") and [r.pos for r in own] == list(range(len(own)))
            assert [r.right_chunk_id for r in own[:-1]] == [r.id for r in own[1:]] and (not own or own[-1].right_chunk_id is None)
            assert all(0 < r.token_count <= 12 for r in own)
        if strategy == "heading":
            assert [r.body for r in rows if r.document_id == 0] == ["intro line\n", "# One\nbody of one\n", "## Two\n#no heading\n", "### \nlast"]
        else:
            assert [r.body for r in rows if r.document_id == 5][:2] == ["First one. Second one! Third?\n\n\n\n", "Next paragraph is here. "]


@pytest.mark.parametrize("strategy, tokenizers", [("heading", 1), ("recursive", 2)])
def test_sections_in_linear_time(spark, strategy, tokenizers):
    """A megabyte of text without a heading, in chunks of twenty tokens."""
    from corpusflow.operators.chunks import cut

    paragraphs = [" ".join(f"w{(i * 7 + j) % 97}" for j in range(40)) + "." for i in range(8000)]
    df = spark.createDataFrame([(1, "\n\n".join(paragraphs))], "i int, t string")
    assert df.select(F.length("t")).first()[0] > 1_000_000
    made = cut(df, "i", "t", ChunkOptions(max_tokens=20, strategy=strategy))
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == tokenizers
    begin = time.time()
    got = made.select("pos", "body", "token_count").collect()
    assert time.time() - begin < 15
    assert "".join(r.body for r in sorted(got)) == "\n\n".join(paragraphs) and max(r.token_count for r in got) <= 20


def test_packing_is_greedy(spark):
    from corpusflow.operators.chunks import _packed

    rnd = random.Random(4)
    cases = [[], [5], [9, 9, 9], [1] * 3000, [rnd.randrange(1, 14) for _ in range(3000)]]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, c array<int>").where(F.size("c") > 0)
    for row in df.select("c", _packed(F.col("c"), 10).alias("starts")).collect():
        want, held = [], 10
        for at, count in enumerate(row.c):
            opens = held + count > 10
            held = count if opens else held + count
            want += [at] * opens
        assert row.starts == want


def test_runs_of_tokens(spark):
    """Chunks cut as runs, and counts by runs, are those of the token array; a long text needs no deep stack."""
    marks = ["a", "é", "1", "½", "Ⅷ", " ", "\n", "\r\n", "\x0b", "\x85", "!", "'s", "😀", "中", "\x00", "𝔘"]
    rows = [(i, "".join(marks[(i * 7 + j * j) % (3 + i % 14)] for j in range(n))) for i, n in enumerate([0, 1, 2, 31, 32, 33, 64, 500, 500, 700] * 3)]
    rows += [(100, None), (101, "a " * 50000), (102, "1" * 100001), (103, "!" * 50000)]
    df = spark.createDataFrame(rows, "i long, text string")
    assert df.where(~token_count(F.col("text")).eqNullSafe(F.size(tokens(F.col("text"))))).count() == 0
    for size in (1, 3, 8191):
        made = token_chunks(df, "i", "text", ChunkOptions(max_tokens=size))
        assert "_runs" in made._jdf.queryExecution().analyzed().toString()
        plain = token_chunks(df, "i", "text", ChunkOptions(max_tokens=size), tokenize=lambda text: tokens(text))
        assert made.count() == plain.count() and made.exceptAll(plain).isEmpty() and plain.exceptAll(made).isEmpty()


def test_long_chunks_are_counted_in_runs(spark):
    """Of the last chunk of a long limit only the last run is looked into, also where it ends with a whole run."""
    lengths = [1, 127, 128, 129, 2000, 2001, 2128, 4500]
    df = spark.createDataFrame([(n, "a" + " b" * (n - 1)) for n in lengths], "i int, t string")
    made = token_chunks(df, "i", "t", ChunkOptions(max_tokens=2000))
    got = {}
    for r in made.orderBy("document_id", "pos").collect():
        got.setdefault(r.document_id, []).append(r.token_count)
    assert got == {n: [2000] * ((n - 1) // 2000) + [(n - 1) % 2000 + 1] for n in lengths}
    assert "{1,128}+" in made._jdf.queryExecution().optimizedPlan().toString()
