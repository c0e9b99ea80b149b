"""Change detection, incremental processing, streaming."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow.checks import inputs
from corpusflow.checks.chunk_queries import OVERLAPPING
from corpusflow.checks.inputs import chunks_sql
from corpusflow.checks.registry import query
from corpusflow.functions.ids import stable_id
from corpusflow.operators import updates
from corpusflow.operators.chunks import token_chunks
from corpusflow.session import materialize, work_dir
from corpusflow.sources.tables import read_table
from corpusflow.streaming import dedup
from corpusflow.streaming import ingest as streaming
from corpusflow.streaming import updates as stream_changes

# The newly landed state: documents judged toxic are gone, those of poor quality
# are revised, conversation turns are new documents.
_INCOMING = """
incoming as (
  select doc_id, source, case when quality = 0 then text || ' Revised.' else text end as text
  from documents left join labels using (doc_id) where coalesce(toxic, 0) = 0
  union all
  select 1000000000 + conv_id * 1000 + turn, 'chat', text from conversations)"""


def _states(spark, folder):
    current = inputs.documents(spark, folder).select("doc_id", "source", "text")
    labels = read_table(spark, folder, "labels")
    judged = current.join(labels, "doc_id", "left").where(F.coalesce("toxic", F.lit(0)) == 0)
    revised = F.when(F.col("quality") == 0, F.concat("text", F.lit(" Revised."))).otherwise(F.col("text"))
    turns = read_table(spark, folder, "conversations").select(
        (F.lit(1000000000) + F.col("conv_id") * 1000 + F.col("turn")).alias("doc_id"), F.lit("chat").alias("source"), "text"
    )
    return current, judged.select("doc_id", "source", revised.alias("text")).unionByName(turns)


@query(
    "updates_report",
    f"""
with {_INCOMING},
compared as (
  select coalesce(n.source, o.source) as source, case when o.doc_id is null then 'new' when n.doc_id is null then 'removed'
    when o.text <> n.text then 'updated' else 'same' end as status
  from documents o full join incoming n using (doc_id))
select source, count(*) filter (where status = 'new') as new_items,
  count(*) filter (where status = 'updated') as updated_items,
  count(*) filter (where status = 'removed') as removed_items, bool_or(status <> 'same') as updated
from compared group by source""",
)
def updates_report(spark, folder):
    current, incoming = _states(spark, folder)
    return updates.check(current, incoming, "doc_id", "source", "text")


@query(
    "updates_apply",
    f"""
with {_INCOMING}, {chunks_sql('incoming', 'doc_id', 'text', 100, 20)}
select document_id, pos, id, md5(body) as body_md5 from chunks""",
)
def updates_apply(spark, folder):
    """Chunks after an incremental run: equal to chunking the whole new state."""
    current, incoming = _states(spark, folder)

    def chunker(df):
        return token_chunks(df, "doc_id", "text", OVERLAPPING)

    stored = materialize(chunker(current), "chunks-before")
    _, after = updates.apply(current, incoming, stored, "doc_id", "source", "text", "document_id", chunker)
    return after.select("document_id", "pos", "id", F.md5("body").alias("body_md5"))


@query(
    "stream_ingest",
    """
with deliveries as (
  select sha256(user_id || chr(31) || sha256(props)) as id, user_id as source_id, props as body, max(ts) as downloaded_at
  from events group by all)
select id, source_id::varchar as source_id, body, strftime(downloaded_at, '%Y-%m-%dT%H:%M:%SZ') as downloaded_at
from deliveries qualify row_number() over (partition by source_id order by downloaded_at desc, id desc) <= 3""",
)
def stream_ingest(spark, folder):
    """Events delivered in several files, a third of them again later: repeats meet, newest three per source kept."""
    events = read_table(spark, folder, "events")
    root = work_dir(spark, "stream")
    again = events.where(F.col("event_id") % 3 == 0).repartition(2, "event_id")
    for rows in (events.repartition(4, F.xxhash64("event_id")), again):
        rows.write.mode("append").parquet(f"{root}/landing")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(f"{root}/landing")

    def to_downloads(batch):
        return batch.select(
            stable_id(F.col("user_id"), F.sha2("props", 256)).alias("id"),
            F.col("user_id").cast("string").alias("source_id"),
            F.col("ts").alias("attempted_at"),
            F.col("ts").alias("downloaded_at"),
            F.lit(200).alias("status_code"),
            F.lit("{}").alias("headers"),
            F.col("props").alias("body"),
        )

    streaming.ingest(stream, to_downloads, f"{root}/tables", f"{root}/checkpoint").awaitTermination()
    streaming.compact(spark, f"{root}/tables")
    done = streaming.current_downloads(spark, f"{root}/tables")
    return done.select(
        "id", "source_id", "body", F.date_format("downloaded_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("downloaded_at")
    )


# Six deliveries ten days apart, each of a sixth of the events. A delivery repeats the one before it (within the
# window of fifteen days); the sixth brings the first one again, long after; the fifth also brings the second with its old times.
_DAY, _BEGIN = 86400, 1704067200
_DELIVERIES = """
delivered as (
  select event_id, b, b * 864000 + event_id % 1000 as sec, 'own' as kind from (select event_id, event_id % 6 as b from events)
  union all
  select event_id, event_id % 6 + 1, (event_id % 6 + 1) * 864000 + event_id % 1000, 'repeat' from events where event_id % 6 < 5
  union all select event_id, 5, 5 * 864000 + event_id % 1000, 'again' from events where event_id % 6 = 0
  union all select event_id, 4, 864000 + event_id % 1000, 'late' from events where event_id % 6 = 1)"""


@query(
    "stream_dedup",
    f"""
with {_DELIVERIES}
select 'late' as outcome, event_id, sec::bigint as sec from delivered where kind = 'late'
union all select 'accepted', event_id, sec::bigint from delivered where kind in ('own', 'again')""",
)
def stream_dedup(spark, folder):
    """Deliveries in six files: repeats within the window go, later ones count as new, late rows are rejects."""
    i = F.col("event_id")
    events = read_table(spark, folder, "events").select("event_id")
    own, day = i % 6, F.lit(10 * _DAY)

    def rows(which, batch, at):
        return which.select("event_id", batch.cast("int").alias("batch"), F.timestamp_seconds(_BEGIN + at * day + i % 1000).alias("ts"))

    parts = [
        rows(events, own, own),
        rows(events.where(own < 5), own + 1, own + 1),
        rows(events.where(own == 0), F.lit(5), F.lit(5)),
        rows(events.where(own == 1), F.lit(4), F.lit(1)),
    ]
    root, schema = work_dir(spark, "dedup"), "event_id bigint, ts timestamp"
    delivered = materialize(parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3]), "deliveries")
    for batch in range(6):
        # One file for each delivery, so that it is one batch of the stream.
        delivered.where(F.col("batch") == batch).drop("batch").coalesce(1).write.mode("append").parquet(f"{root}/landing")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/landing")
    dedup.route(stream, "ts", "15 days", root, f"{root}/cp1").awaitTermination()
    dedup.suppress(spark, schema, ["event_id"], "ts", "15 days", root, f"{root}/cp2", files_at_once=1).awaitTermination()
    found = [dedup.read(spark, root, t, schema).select(F.lit(t).alias("outcome"), "event_id", (F.unix_seconds("ts") - _BEGIN).alias("sec")) for t in (dedup.LATE, dedup.ACCEPTED)]
    return found[0].unionAll(found[1])


@query(
    "stream_updates",
    f"""
with {_INCOMING},
compared as (
  select coalesce(n.doc_id, o.doc_id) as doc_id, case when o.doc_id is null then 'new' when n.doc_id is null then 'removed'
    when o.text <> n.text then 'updated' else 'same' end as status
  from documents o full join incoming n using (doc_id))
select doc_id, status from compared""",
)
def stream_updates(spark, folder):
    """The two states of updates_report as crawls of a stream: what the second one changes, and what it no longer has."""
    root, schema = work_dir(spark, "crawls"), "doc_id bigint, text string, ts timestamp"
    crawls = [(rows.select("doc_id", "text"), day * _DAY) for day, rows in enumerate(_states(spark, folder))]
    # A row of another kind carries the time on, past the grace of what was there on the first day only.
    crawls.append((spark.createDataFrame([(None, None)], "doc_id bigint, text string"), int(1.8 * _DAY)))
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", stream_changes.PROVIDER)
    try:
        # Each crawl lands in as many files as it has tasks, and the stream goes on from its checkpoint: one batch for each.
        for rows, second in crawls:
            rows.withColumn("ts", F.timestamp_seconds(F.lit(_BEGIN + second))).write.mode("append").parquet(f"{root}/landing")
            stream = spark.readStream.schema(schema).parquet(f"{root}/landing")
            stream = stream.withColumn("key", F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
            found = stream_changes.track(stream, "key", "text", "ts", "0 seconds", "36 hours")
            out = found.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/cp")
            out.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    finally:
        if before is None:
            spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
        else:
            spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    rows = spark.read.schema("key string, status string, seen timestamp").parquet(f"{root}/out").where("key <> ''")
    second = (F.unix_seconds("seen") >= _BEGIN + _DAY) | (F.col("status") == "removed")
    return rows.where(second).select(F.col("key").cast("bigint").alias("doc_id"), "status")
