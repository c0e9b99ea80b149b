import datetime

from pyspark.sql import functions as F

from corpusflow import schemas
from corpusflow.operators import integrity, listing, outcome, tags, updates, upsert
from corpusflow.sources.snapshots import complete_snapshots, read_snapshot, write_snapshot

def stamp():
    return F.lit("2024-01-01 00:00:00").cast("timestamp")


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_retention_keeps_newest_three(spark):
    times = [None, "2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"]
    df = spark.createDataFrame([(f"d{i}", "s", t, "b") for i, t in enumerate(times)], "id string, source_id string, t string, body string")
    df = df.withColumn("downloaded_at", F.col("t").cast("timestamp"))
    assert rows(upsert.retain_newest(df), "id") == [("d2",), ("d3",), ("d4",)]
    assert rows(upsert.retain_newest(df.limit(2)), "id") == [("d0",), ("d1",)]


def test_rank_limit_reaches_the_map_side(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = upsert.newest_per_key(df, ["user_id"], [F.col("ts").desc()], 3)._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and plan.count("WindowGroupLimit") == 2


def test_upsert_and_insert(spark):
    base = spark.createDataFrame([(1, "old", 0), (2, "old", 0)], "k int, v string, t int")
    new = spark.createDataFrame([(2, "a", 1), (2, "b", 2), (3, "c", 1)], "k int, v string, t int")
    order = [F.col("t").desc()]
    assert rows(upsert.upsert(base, new, ["k"], order), "k", "v") == [(1, "old"), (2, "b"), (3, "c")]
    assert rows(upsert.insert_absent(base, new, ["k"], order), "k", "v") == [(1, "old"), (2, "old"), (3, "c")]
    again = upsert.upsert(upsert.upsert(base, new, ["k"], order), new, ["k"], order)
    assert rows(again, "k", "v") == [(1, "old"), (2, "b"), (3, "c")]


def test_checked_insert(spark):
    base = spark.createDataFrame([("a", 1)], "id string, v int")
    new = spark.createDataFrame([("a", 1), ("b", 2), ("b", 2), ("b", 3), ("c", -1)], "id string, v int")
    accepted, rejected = upsert.insert_checked(base, new, "id", {"ErrNegative": F.col("v") < 0}, [F.col("v")])
    assert rows(accepted, "id", "v") == [("b", 2)]
    assert rows(rejected, "id", "v", "error") == [
        ("a", 1, "ErrDuplicateKey"), ("b", 2, "ErrDuplicateKey"), ("b", 3, "ErrDuplicateKey"), ("c", -1, "ErrNegative"),
    ]


def test_update_delete_lookup(spark):
    base = spark.createDataFrame([(1, "h", None), (2, "h", None)], "id int, host string, updated_at timestamp")
    change = spark.createDataFrame([(2, None), (9, "x")], "id int, host string")
    done = upsert.update(base, change, "id", ["host"], stamp())
    assert [(r.id, r.host, r.updated_at) for r in done.orderBy("id").collect()] == [
        (1, "h", None), (2, None, datetime.datetime(2024, 1, 1)),
    ]
    assert rows(upsert.delete(base, change, ["id"]), "id") == [(1,)]
    found, missing = upsert.lookup(base, change, "id")
    assert rows(found, "id") == [(2,)] and rows(missing, "id", "error") == [(9, "ErrNotFound")]


def test_tags(spark):
    old = spark.createDataFrame([("t1", "news")], "id string, name string").withColumn("created_at", stamp())
    links = spark.createDataFrame([("l", "d1", "t1")], "id string, document_id string, tag_id string").withColumn("created_at", stamp())
    terms = spark.createDataFrame([("d1", "news"), ("d1", "x"), ("d2", "x"), ("d2", "x"), ("d2", None)], "document_id string, name string")
    all_tags, all_links = tags.link(terms, old, links, stamp())
    assert sorted(r.name for r in all_tags.collect()) == ["news", "x"]
    assert all_links.count() == 3
    assert all_links.join(all_tags, all_links.tag_id == all_tags.id, "left_anti").count() == 0
    again_tags, again_links = tags.link(terms, all_tags, all_links, stamp())
    assert again_tags.count() == 2 and again_links.count() == 3


def test_integrity(spark):
    tables = {name: schemas.empty_table(spark, name) for name in schemas.SCHEMAS}
    assert integrity.integrity_report(tables).count() == 0
    tables["chunks"] = spark.createDataFrame(
        [("c1", "doc", None, "nowhere", None, "de", "sql"), ("c1", "doc", None, None, None, "fr", "rust")],
        "id string, document_id string, parent_chunk_id string, left_chunk_id string, right_chunk_id string, "
        "natural_lang string, code_lang string",
    )
    report = integrity.integrity_report(tables)
    assert rows(report, "rule", "key") == [
        ("chunks.code_lang", "c1"), ("chunks.document_id->documents", "c1"), ("chunks.document_id->documents", "c1"),
        ("chunks.left_chunk_id->chunks", "c1"), ("chunks.natural_lang", "c1"), ("chunks.unique(id)", "c1"),
    ]


def test_listing(spark):
    df = spark.createDataFrame(
        [("a", "2024-01-01T00:00:00Z"), ("b", "2024-01-02 00:00:00"), ("c", "bad")], "id string, created_at string"
    )
    good, bad = listing.parse_times(df, ["created_at"])
    assert [r.json for r in listing.json_rows(listing.newest_sources(good)).collect()] == [
        '{"id":"b","created_at":"2024-01-02T00:00:00Z"}', '{"id":"a","created_at":"2024-01-01T00:00:00Z"}',
    ]
    assert rows(bad, "id", "error") == [("c", "ErrUnsupportedTimestampFormat")]
    assert [r.id for r in listing.first_sources(good, 1).collect()] == ["b"]


def test_requests(spark):
    requests = spark.createDataFrame(
        [("r1", '["c2","c1"]'), ("r2", "c1, c3"), ("r3", ""), ("r4", None)], "id string, result_chunks string"
    )
    chunks = spark.createDataFrame([("c1", "x"), ("c2", "y")], "id string, body string")
    assert rows(listing.expand_requests(requests, chunks), "request_id", "pos", "body") == [
        ("r1", 0, "y"), ("r1", 1, "x"), ("r2", 0, "x"),
    ]


def test_outcome(spark):
    df = spark.createDataFrame(
        [("a", 1, "u1", None), ("a", 2, "u2", "E2"), ("a", 3, "u3", "E3"), ("b", 1, "u4", "E4"), ("c", 1, "u5", None)],
        "g string, n int, item string, error string",
    )
    assert rows(outcome.summary(df, "g", "n", "item"), "g", "total", "failed", "first_error", "last_ok", "outcome") == [
        ("a", 3, 2, "E2", "u1", "ErrImportCompleted"), ("b", 1, 1, "E4", None, "failed"), ("c", 1, 0, None, "u5", "ok"),
    ]


def test_updates(spark):
    old = spark.createDataFrame([(1, "s", "a"), (2, "s", "b"), (3, "t", None)], "k int, g string, body string")
    new = spark.createDataFrame([(1, "s", "a"), (2, "s", "B"), (3, "t", None), (4, "u", "d")], "k int, g string, body string")
    assert rows(updates.changes(old, new, "k", "g", "body"), "k", "status") == [(1, "same"), (2, "updated"), (3, "same"), (4, "new")]
    assert rows(updates.check(old, new, "k", "g", "body"), "g", "new_items", "updated_items", "updated") == [
        ("s", 0, 1, True), ("t", 0, 0, False), ("u", 1, 0, True),
    ]
    assert rows(updates.changed_rows(old, new, "k", "g", "body"), "k") == [(2,), (4,)]
    assert rows(updates.check(new, old, "k", "g", "body"), "g", "removed_items") == [("s", 0), ("t", 0), ("u", 1)]


def test_snapshots(spark, tmp_path):
    root = str(tmp_path)
    assert read_snapshot(spark, root, "tags").count() == 0
    one = spark.createDataFrame([("1", "a")], "id string, name string").withColumn("created_at", stamp())
    write_snapshot(one, root, "tags", 1)
    write_snapshot(read_snapshot(spark, root, "tags").unionByName(one.withColumn("id", F.lit("2"))), root, "tags", 2)
    write_snapshot(read_snapshot(spark, root, "tags", before=2).unionByName(one.withColumn("id", F.lit("2"))), root, "tags", 2)
    assert complete_snapshots(spark, root, "tags") == [1, 2]
    assert rows(read_snapshot(spark, root, "tags"), "id") == [("1",), ("2",)]
    assert rows(read_snapshot(spark, root, "tags", before=2), "id") == [("1",)]
