"""Bucketed tables: what a change rewrites, empty buckets, a save that broke off."""

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from corpusflow.operators.embed import hashing_embedder
from corpusflow.operators.upsert import merge_downloads
from corpusflow.options import ChunkOptions, IngestOptions
from corpusflow.plans import ingest, store
from corpusflow.session import materialize, work_dir
from corpusflow.sources import landing
from corpusflow.sources.buckets import BUCKET, BucketTable, bucket_count

OPTIONS = IngestOptions(chunks=ChunkOptions(max_tokens=5))
VECTORS = "id string, model string, object_id string"


def at(hour):
    return F.lit(f"2024-01-01 {hour:02d}:00:00").cast("timestamp")


def state_of(spark, texts, hour):
    """(sources, downloads) of text files by number."""
    rows = spark.createDataFrame([(f"https://github.com/o/r/blob/main/{n}.md", t, '{"X-GitHub-SHA":["a"]}') for n, t in texts.items()], "raw_url string, body string, headers string")
    rows = rows.withColumns({"attempted_at": at(hour), "status_code": F.lit(200)})
    return landing.source_rows(rows, "raw_url", F.lit("json"), at(hour)), landing.download_rows(rows, "raw_url", F.col("headers"), at(hour))


def first_run(spark, texts, model="m1", hour=0):
    sources, downloads = state_of(spark, texts, hour)
    return ingest.process_downloads(downloads, sources, hashing_embedder(model), at(hour), OPTIONS, {64: "embedding_64"})


def files_of(root, name):
    return {str(p): p.stat().st_mtime_ns for p in Path(root, name).rglob("*.parquet")}


def contents(spark, root):
    names = ("sources", "downloads", "documents", "document_meta", "chunks")
    out = {n: sorted(map(str, store.read(spark, root, n).collect())) for n in names}
    return out | {"embeddings": sorted(tuple(r) for r in store.read(spark, root, "embeddings", schema=VECTORS).collect())}


def test_a_change_rewrites_its_buckets(spark):
    """A hundredth of the keys, in a hundredth of the buckets."""
    root = work_dir(spark, "store")
    stored = BucketTable(spark, f"{root}/t", "id string, n int", 100)
    rows = spark.range(2000).select(F.col("id").cast("string").alias("id"), F.lit(1).alias("n"))
    dealt = rows.withColumn(BUCKET, stored.bucket(F.col("id")))
    stored.change(list(range(100)), lambda old: dealt)
    before = files_of(root, "t")
    assert len({Path(p).parent for p in before}) == 100
    some = dealt.where(F.col(BUCKET) == 42)
    touched = stored.touched(some.select("id"))
    stored.change(touched, lambda old: old.withColumn("n", F.lit(2)))
    after = files_of(root, "t")
    changed = {Path(p).parent.name for p in before.keys() ^ after.keys()}
    assert touched == [42] and changed == {"bucket=42"}
    assert stored.read().groupBy("n").count().where("n = 2").first()["count"] == some.count()
    assert stored.read([42]).inputFiles() and all("bucket=42" in f for f in stored.read([42]).inputFiles())
    assert stored.read().count() == 2000


def test_empty_buckets_go(spark):
    root = work_dir(spark, "store")
    stored = BucketTable(spark, f"{root}/t", "id string", 8)
    rows = spark.range(100).select(F.col("id").cast("string").alias("id"))
    stored.change(list(range(8)), lambda old: rows.withColumn(BUCKET, stored.bucket(F.col("id"))))
    stored.change([3, 5], lambda old: old.where(F.col(BUCKET) == 3))
    assert sorted(p.name for p in Path(root, "t").glob("bucket=*")) == [f"bucket={b}" for b in range(8) if b != 5]
    stored.change([], lambda old: 1 / 0)
    stored.change(list(range(8)), lambda old: old.limit(0))
    assert stored.read().count() == 0 and list(Path(root, "t").glob("bucket=*")) == []


def test_the_number_of_buckets_stays(spark):
    root = work_dir(spark, "store")
    assert [bucket_count(spark, root, n) for n in (16, 64)] == [16, 16]
    with pytest.raises(ValueError, match="ErrBucketCount"):
        bucket_count(spark, root, 0)


def test_a_run_over_one_document(spark):
    root = work_dir(spark, "store")
    texts = {n: f"text {n} has some words and more of them, one after the other" for n in range(60)}
    store.save(first_run(spark, texts), root, buckets=64)
    before = {n: files_of(root, n) for n in ("sources", "documents", "document_meta", "chunks", "embeddings")}
    store.save(first_run(spark, {7: "now short"}, "m2", 1), root)
    for name, files in before.items():
        after = files_of(root, name)
        assert len({Path(p).parent for p in files.keys() ^ after.keys()}) == 1, name
    assert store.read(spark, root, "documents").count() == 60
    models = store.read(spark, root, "embeddings", schema=VECTORS).groupBy("model").count().collect()
    assert {r["model"] for r in models} == {"m1", "m2"} and min(r["count"] for r in models) == 1
    one = store.read(spark, root, "documents").limit(1).select("id")
    assert len(store.read(spark, root, "chunks", one).inputFiles()) == 1


@pytest.mark.parametrize("broken", ["chunks"])
def test_a_save_that_broke_off(spark, monkeypatch, broken):
    """Saving again after a failure at any table gives what an unbroken save gives."""
    texts = {n: f"text {n} has some words and more of them" for n in range(12)}
    changed = {n: t if n % 3 else t + " changed here" for n, t in texts.items() if n != 5}
    roots = [work_dir(spark, "store") for _ in range(2)]
    for root in roots:
        store.save(first_run(spark, texts), root, buckets=4)

    def update(root):
        sources, downloads = state_of(spark, changed, 2)
        return ingest.process_updates(store.read(spark, root, "downloads"), downloads, sources, hashing_embedder("m2"), at(2), OPTIONS, {64: "embedding_64"})

    store.save(update(roots[0]), roots[0])
    run, change = update(roots[1]), BucketTable.change

    def failing(self, touched, make):
        if self.folder.endswith(broken):
            # A part of the buckets is there already.
            change(self, touched[: len(touched) // 2], lambda old: make(old).where(F.col(BUCKET).isin(touched[: len(touched) // 2])))
            raise RuntimeError("lost")
        change(self, touched, make)

    monkeypatch.setattr(BucketTable, "change", failing)
    with pytest.raises(RuntimeError, match="lost"):
        store.save(run, roots[1])
    monkeypatch.setattr(BucketTable, "change", change)
    store.save(run, roots[1])
    assert contents(spark, roots[1]) == contents(spark, roots[0])


def test_intermediate_results_are_packed(spark):
    from corpusflow.session import materialize

    files = materialize(spark.range(10).selectExpr("cast(id as string) as body"), "packed").inputFiles()
    assert files and all(".zstd." in f for f in files)


def shuffle_files(spark):
    """Names of the shuffle files that the session holds."""
    held = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(",")
    return {name for path in held.split(",") if (name := path.rpartition("/")[2]).startswith("shuffle_") and name.endswith(".data")}


def test_what_was_shuffled_goes_when_it_is_written(spark):
    stored = BucketTable(spark, f"{work_dir(spark, 'store')}/t", "id string, n bigint", 4)
    counts = spark.range(1000).repartition(3).groupBy((F.col("id") % 100).cast("string").alias("id")).agg(F.count("*").alias("n"))
    before = shuffle_files(spark)
    assert len(materialize(counts, "counts").collect()) == 100
    keys = stored.touched(counts.select("id"))
    stored.change(keys, lambda old: counts.withColumn(BUCKET, stored.bucket(F.col("id"))))
    assert keys == [0, 1, 2, 3] and len(stored.read().collect()) == 100
    for _ in range(50):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_bodies_of_downloads_meet_one_join(spark):
    """Sources a (merged), b (untouched), c (gone), and one of no name; bodies are exchanged once."""
    row = "id string, source_id string, attempted_at timestamp, downloaded_at timestamp, status_code int, headers string, body string"

    def rows(*given):
        made = spark.createDataFrame([(i, s, f"2024-01-01 {h:02d}:00:00", 200, "{}", b) for i, s, h, b in given], "id string, source_id string, t string, status_code int, headers string, body string")
        t = F.col("t").cast("timestamp")
        return made.select("id", "source_id", t.alias("attempted_at"), t.alias("downloaded_at"), "status_code", "headers", "body").to(spark.createDataFrame([], row).schema)

    current = rows(("a1", "a", 1, "one"), ("a2", "a", 2, "two"), ("b1", "b", 1, "b"), ("b1", "b", 1, "b"), ("c1", "c", 1, "c"), ("n1", None, 1, "n"))
    arrived = rows(("a2", "a", 3, "two"), ("a3", "a", 4, "three"), ("n2", None, 2, "m"))
    gone = spark.createDataFrame([("c",)], "source_id string")
    merged = merge_downloads(current, arrived, 2, gone)
    scans = [line for line in merged._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line]
    assert len(scans) > 1 and sum("body#" in line for line in scans) == 1
    assert sorted(r.id for r in merged.collect()) == ["a2", "a3", "b1", "b1", "n1", "n2"]
    assert {r.downloaded_at.hour for r in merged.where("id = 'a2'").collect()} == {3}
    assert sorted(r.id for r in merge_downloads(current, arrived, 1).collect()) == ["a3", "b1", "b1", "c1", "n1", "n2"]


def test_bodies_on_the_way_are_deleted(spark):
    root = work_dir(spark, "store")
    folder = Path(root).parent
    before = {p.name for p in folder.iterdir()}
    store.save(first_run(spark, {1: "a b c", 2: "d e f"}), root, buckets=4)
    left = {p.name.rpartition("-")[0] for p in folder.iterdir() if p.name not in before}
    assert not left & {"marked_downloads", "merged_downloads", "downloads"} and "staged" in left
    assert all(".zstd." in p.name for p in Path(root).rglob("chunks/*/*.parquet"))
