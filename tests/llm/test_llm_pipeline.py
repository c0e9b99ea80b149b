"""The stages of the pipeline on rows without an id, repeated rows and columns with the operators' own names."""

import random

import pytest

import corpus_pipeline as pipeline

NAMES = ["score", "predicted", "n_lines", "n_dropped", "raw", "_key", "none", "n_chars", "component_id", "n.x"]


def prose(seed, n=60):
    rnd = random.Random(seed)
    return " ".join(f"w{rnd.randrange(400)}" for _ in range(n))


@pytest.fixture
def make(spark):
    def docs(rows):
        schema = "doc_id long, text string, " + ", ".join(f"`{n}` {'long' if n == 'n_chars' else 'string'}" for n in NAMES)
        return spark.createDataFrame([(d, t, *(len(t) if n == "n_chars" else f"{n}{i}" for n in NAMES)) for i, (d, t) in enumerate(rows)], schema)

    return docs


def stage(name, spark, docs, folder):
    out = dict(pipeline.STAGES)[name](spark, docs, str(folder))
    got = out.collect()
    assert out.columns[: len(docs.columns)] == docs.columns
    # Own columns come through with their row.
    own = {r["score"]: r for r in docs.collect()}
    for r in got:
        assert all(r[n] == own[r["score"]][n] for n in ["doc_id", *NAMES] if n != "n_chars") and r["n_chars"] == len(r["text"])
    return sorted(((-1 if r["doc_id"] is None else r["doc_id"]), r["text"]) for r in got)


def test_toxicity_stage(spark, make, tmp_path):
    bad = " vileword nasty"
    spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    rows = [(i, prose(i) + (bad if i % 3 == 0 else "")) for i in range(300)]
    more = [(None, prose(900)), (None, prose(901) + bad), (1, prose(902)), (1, prose(903) + bad), (2, prose(904)), (2, prose(904))]
    got = stage("toxicity", spark, make(rows + more), tmp_path)
    assert got == sorted((-1 if d is None else d, t) for d, t in rows + more if bad not in t)


def test_line_stage(spark, make, tmp_path):
    line = "a long line that is in all of them"
    rows = [(None, f"{line}\nn{i}") for i in range(3)] + [(None, f"{line}\nn0")] + [(5, f"{line}\nfive")] * 2
    got = stage("line_dedup", spark, make(rows), tmp_path)
    assert got == [(-1, "n0"), (-1, "n0"), (-1, "n1"), (-1, "n2"), (5, f"{line}\nfive"), (5, f"{line}\nfive")]
    two = [(7, f"{line}\nx")] * 3 + [(None, f"{line}\ny")] * 3
    assert [t.count(line) for _, t in stage("line_dedup", spark, make(two), tmp_path)] == [1] * 6


def test_near_copy_stage(spark, make, tmp_path):
    a, b, c, d = (prose(i, 200) for i in range(4))
    rows = [(9, a), (3, a + " more"), (None, a), (4, b), (4, b), (4, b), (None, c), (None, c), (6, d), (6, prose(8)), (7, d), (5, ""), (5, ""), (None, "")]
    got = stage("near_dedup", spark, make(rows), tmp_path)
    assert got == sorted([(3, a + " more"), (4, b), (-1, c), (6, d), (6, prose(8)), (5, ""), (5, ""), (-1, "")])


def test_item_stage(spark, make, tmp_path):
    item = prose(50, 30)
    spark.createDataFrame([(1, item), (None, prose(51, 30))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, f"{prose(1)} {item} {prose(2)}"), (None, prose(3)), (1, item), (1, prose(4)), (1, prose(4)), (2, prose(5) + " " + prose(51, 30))]
    assert stage("decontamination", spark, make(rows), tmp_path) == sorted([(-1, prose(3)), (1, prose(4)), (1, prose(4))])


def test_token_stage(spark, make, tmp_path):
    from pyspark.sql import functions as F

    docs = make([(None, "one two"), (1, "x"), (1, "x"), (2, "")]).withColumn("n_tokens", F.lit("own")).withColumn("IDS", F.lit("own"))
    out = pipeline.encode_bytes(spark, docs, "")
    out.write.parquet(f"{tmp_path}/out")
    assert out.columns == ["doc_id", "text", *NAMES, "n_tokens", "ids"]
    assert sorted(r["text"] for r in out.collect()) == ["", "one two", "x", "x"]
    assert all(r["raw"].startswith("raw") and r["n_tokens"] == len(r["ids"]) for r in out.collect())
