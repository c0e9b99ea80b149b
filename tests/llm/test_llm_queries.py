"""Every query of the training-data operators on the smallest tables, against SQL or a plain version."""

import base64
import hashlib
import html
import re
import sys
import zlib
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

import brute
import duckdb
import public_tokenizers
from oracle import difference

import __spark_entry__ as entry_points
from corpusflow.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


def table(sql, folder=FOLDER):
    return duckdb.connect().execute(sql.format(f=folder)).fetchall()


@pytest.fixture(scope="module")
def documents():
    return table("select doc_id, text, lang from '{f}/documents.parquet'")


def test_registered():
    assert set(QUERIES) <= set(entry_points.queries()) and "pipeline" in entry_points.queries()
    assert [sum(n.startswith(f"op{i}_") for n in QUERIES) for i in range(1, 14)] == [1] * 13


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    assert difference(spark, FOLDER, QUERIES[name], ORACLES[name]) is None


def test_language(spark):
    rows = table("select doc_id, lang from '/root/testdata/sf0.01/documents.parquet'")
    got = {r["doc_id"]: r for r in QUERIES["op2_language"](spark, "/root/testdata/sf0.01").collect()}
    assert len(got) == len(rows)
    assert all(got[d]["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) and 0 <= got[d]["score"] <= 1 for d, _ in rows)
    right = [got[d]["lang_pred"] == lang for d, lang in rows if got[d]["held_out"]]
    assert sum(right) >= 0.98 * len(right)


def test_toxicity(spark):
    labels = dict(table("select doc_id, toxic from '/root/testdata/sf0.01/labels.parquet'"))
    got = {r["doc_id"]: r for r in QUERIES["op9_toxicity"](spark, "/root/testdata/sf0.01").collect()}
    assert len(got) == 1000 and all((r["score"] >= 0.5) == (r["predicted"] == 1) for r in got.values())
    held = [(got[d]["predicted"], y) for d, y in labels.items() if got[d]["held_out"]]
    assert sum(p == y for p, y in held) >= 0.9 * len(held)
    english = {d for d, _, lang in table("select doc_id, text, lang from '/root/testdata/sf0.01/documents.parquet'") if lang == "en"}
    wrong = [d for d, y in labels.items() if d in english and got[d]["predicted"] != y]
    assert len(wrong) <= 0.05 * len(labels)


def test_token_counts(spark, documents):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {d: (len(t.encode()), len(library.encode(t, add_special_tokens=False).ids)) for d, t, _ in documents}
    rows = QUERIES["op4_token_counts"](spark, FOLDER).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in rows} == want
    assert all(r["over_limit"] == (r["n_tokens"] > 1024) for r in rows)


def test_near_duplicates(spark, documents):
    rows = QUERIES["op5_near_duplicates"](spark, FOLDER).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == brute.near_duplicates([d[:2] for d in documents], 4)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)


def test_main_text(spark):
    def gold(page):
        article = page[page.index("<article>") : page.index("</article>")]
        blocks = [html.unescape(re.sub("<[^>]*>", " ", b)).split() for b in re.split("</?(?:p|h1)[^>]*>", article)]
        return "\n".join(" ".join(b) for b in blocks if b)

    want = {p: (u, gold(h)) for p, u, h in table("select page_id, url, html from '{f}/pages.parquet'")}
    rows = QUERIES["op6_main_text"](spark, FOLDER).collect()
    assert {r["page_id"]: (r["url"], r["text"]) for r in rows} == want
    assert all(r["n_chars"] == len(r["text"]) for r in rows)


def test_byte_bpe(spark, documents):
    import tiktoken

    lines = open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {}
    for d, t, _ in documents:
        ids = library.encode_ordinary(t)
        digests = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()
        want[d] = (len(ids), *digests)
    rows = QUERIES["op7_byte_bpe"](spark, FOLDER).collect()
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows} == want


def test_periodic_runs(spark, documents):
    want = {}
    for d, t, _ in documents:
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        h, n = zlib.crc32(str(d).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        found = brute.runs(words)
        best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=(None,) * 3)
        told = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        milli = best[1] and 1000 * best[1] // best[2]
        want[d] = (len(found), *best, milli, *(hashlib.sha256(x.encode()).hexdigest() for x in (told, brute.collapsed(words, found))))
    rows = QUERIES["op13_periodic_runs"](spark, FOLDER).collect()
    names = "n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()
    assert {r["doc_id"]: tuple(r[n] for n in names) for r in rows} == want
    assert sum(w[0] > 0 for w in want.values()) >= 10


def test_mixture_is_near_its_targets(spark):
    from pyspark.sql import functions as F

    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").withColumn("source", F.concat("source", F.lit("x")))
    docs = docs.withColumn("source", F.when(F.crc32("text") % 3 == 0, F.lit(None)).otherwise(F.regexp_replace("source", r"\d", "")))
    from corpusflow.llm import mixing

    rows = mixing.repetitions(docs).withColumn("taken", F.col("copies") * mixing.word_count(F.col("text")))
    got = rows.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max("copies").alias("most")).collect()
    assert len(got) == 2 and all(abs(r["taken"] - r["target"]) <= 0.02 * r["target"] and r["most"] <= 2 for r in got)


def test_pipeline(spark, documents):
    """The stages after the classifier, against plain versions of each on what it kept."""
    import corpus_pipeline
    from corpusflow.session import materialize

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = materialize(corpus_pipeline.remove_toxic(spark, docs, FOLDER), "test")
    labels = dict(table("select doc_id, toxic from '{f}/labels.parquet'"))
    left = {r["doc_id"] for r in kept.collect()}
    assert kept.columns == docs.columns
    assert sum(labels[d] == 0 for d in set(labels) - left) <= 0.02 * len(labels)

    rows = {r["doc_id"]: r["text"] for r in kept.collect()}
    rows = {d: t for d, (t, _, _) in brute.dedup_lines(rows.items()).items()}
    groups = brute.near_duplicates(rows.items(), 5)
    rows = {d: t for d, t in rows.items() if groups[d][1] == d}
    items = table("select item_id, text from '{f}/benchmark.parquet'")
    leaks = {d for d, _ in brute.contained(rows.items(), items)}
    rows = {d: t for d, t in rows.items() if d not in leaks}

    out = kept
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        out = materialize(stage(spark, out, FOLDER), "test")
        assert out.columns == docs.columns
    last = corpus_pipeline.encode_bytes(spark, out, FOLDER).collect()
    assert {r["doc_id"]: r["text"] for r in last} == rows
    assert all(r["n_tokens"] == len(r["ids"]) and r["n_chars"] == len(r["text"]) for r in last)
    assert {(r["doc_id"], r["n_tokens"]) for r in corpus_pipeline.run(spark, FOLDER).collect()} == {(r["doc_id"], r["n_tokens"]) for r in last}
