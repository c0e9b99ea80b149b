"""Keyed tables: retention, upserts, tags, integrity, listings."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow.checks import inputs
from corpusflow.checks.registry import query
from corpusflow.functions.ids import stable_id
from corpusflow.functions.times import format_utc
from corpusflow.operators import integrity, listing, tags, upsert
from corpusflow.schemas import ReferenceRule
from corpusflow.sources.tables import read_table

_CUT = "2024-01-16"


@query(
    "retention_last3",
    f"""
with {inputs.DOWNLOADS_SQL}
select id, source_id, status_code, body from downloads
qualify row_number() over (partition by source_id order by downloaded_at desc nulls last, id desc) <= 3""",
)
def retention_last3(spark, folder):
    kept = upsert.retain_newest(inputs.event_downloads(spark, folder), 3)
    return kept.select("id", "source_id", "status_code", "body")


@query(
    "latest_per_source",
    f"""
with {inputs.DOWNLOADS_SQL}
select id, source_id, body from downloads
qualify row_number() over (partition by source_id order by downloaded_at desc nulls last, id desc) = 1""",
)
def latest_per_source(spark, folder):
    order = [F.col("downloaded_at").desc_nulls_last(), F.col("id").desc()]
    newest = upsert.newest_per_key(inputs.event_downloads(spark, folder), ["source_id"], order)
    return newest.select("id", "source_id", "body")


@query(
    "meta_upsert",
    """
select sha256(user_id || chr(31) || event_type) as id, user_id as document_id, event_type as key, props as meta
from events qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1""",
)
def meta_upsert(spark, folder):
    """Metadata rows of the first half month, then those of the second on top."""
    events = read_table(spark, folder, "events")
    order = [F.col("ts").desc(), F.col("event_id").desc()]
    rows = events.select(
        stable_id("user_id", "event_type").alias("id"), F.col("user_id").alias("document_id"),
        F.col("event_type").alias("key"), F.col("props").alias("meta"), "ts", "event_id",
    )
    early, late = rows.where(F.col("ts") < _CUT), rows.where(F.col("ts") >= _CUT)
    base = upsert.newest_per_key(early, ["document_id", "key"], order)
    return upsert.upsert(base, late, ["document_id", "key"], order).drop("ts", "event_id")


@query(
    "document_upsert",
    """
select o_custkey as source_id, o_orderkey as download_id, o_orderpriority as format from orders
qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1""",
)
def document_upsert(spark, folder):
    """Documents per source: those of the years to 1997, then the later ones on top."""
    rows = read_table(spark, folder, "orders").select(
        F.col("o_custkey").alias("source_id"), F.col("o_orderkey").alias("download_id"),
        F.col("o_orderpriority").alias("format"), F.col("o_orderdate").alias("seen"),
    )
    order = [F.col("seen").desc(), F.col("download_id").desc()]
    base = upsert.newest_per_key(rows.where("seen < '1998-01-01'"), ["source_id"], order)
    return upsert.upsert(base, rows.where("seen >= '1998-01-01'"), ["source_id"], order).drop("seen")


_NEW_SOURCES = """
new_sources as (
  select 's' || c_custkey // 2 as id, case when c_nationkey = 0 then '' else 'https://c.org/' || c_custkey end as raw_url,
    case when c_acctbal < 0 then 2 else 1 end as active_domain,
    case c_mktsegment when 'MACHINERY' then 'xml' when 'BUILDING' then 'yaml' else 'json' end as format
  from customer),
old_sources as (
  select 's' || s_suppkey as id, 'https://s.org/' || s_suppkey as raw_url, 1 as active_domain, 'json' as format
  from supplier)"""


@query(
    "source_insert",
    f"""
with {_NEW_SOURCES},
judged as (
  select *, case when raw_url = '' then 'ErrBlankURL' when active_domain not in (0, 1) then 'ErrActiveDomain'
    when format not in ('json', 'yml', 'yaml', 'md') then 'ErrFormat' end as bad from new_sources),
ranked as (
  select *, row_number() over (partition by id, bad is null order by raw_url) as rn,
    id in (select id from old_sources) as seen from judged),
final as (
  select id, raw_url, active_domain, format,
    coalesce(bad, case when seen or rn > 1 then 'ErrDuplicateKey' end) as error from ranked)
select *, null as error from old_sources union all select * from final""",
)
def source_insert(spark, folder):
    customers = read_table(spark, folder, "customer")
    suppliers = read_table(spark, folder, "supplier")
    segment = F.col("c_mktsegment")
    new = customers.select(
        F.concat(F.lit("s"), F.floor(F.col("c_custkey") / 2).cast("string")).alias("id"),
        F.when(F.col("c_nationkey") == 0, "").otherwise(
            F.concat(F.lit("https://c.org/"), F.col("c_custkey").cast("string"))
        ).alias("raw_url"),
        F.when(F.col("c_acctbal") < 0, 2).otherwise(1).alias("active_domain"),
        F.when(segment == "MACHINERY", "xml").when(segment == "BUILDING", "yaml").otherwise("json").alias("format"),
    )
    base = suppliers.select(
        F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("id"),
        F.concat(F.lit("https://s.org/"), F.col("s_suppkey").cast("string")).alias("raw_url"),
        F.lit(1).alias("active_domain"), F.lit("json").alias("format"),
    )
    checks = {
        "ErrBlankURL": F.col("raw_url") == "",
        "ErrActiveDomain": ~F.col("active_domain").isin(0, 1),
        "ErrFormat": ~F.col("format").isin("json", "yml", "yaml", "md"),
    }
    accepted, rejected = upsert.insert_checked(base, new, "id", checks, [F.col("raw_url")])
    none = F.lit(None).cast("string").alias("error")
    return base.unionByName(accepted).select("*", none).unionByName(rejected)


@query(
    "source_update",
    f"""
select c_custkey as id, case when s_suppkey is not null then s_name else c_name end as host,
  case when s_suppkey is not null then case when s_acctbal < 0 then null else 'https' end else c_mktsegment end as scheme,
  case when s_suppkey is not null then '{inputs.STAMP_TEXT}' else '2024-01-01T00:00:00Z' end as updated_at
from customer left join supplier on s_suppkey = c_custkey""",
)
def source_update(spark, folder):
    base = read_table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("host"), F.col("c_mktsegment").alias("scheme"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("updated_at"),
    )
    suppliers = read_table(spark, folder, "supplier")
    change = suppliers.select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("host"),
        F.when(F.col("s_acctbal") >= 0, "https").alias("scheme"),
    )
    done = upsert.update(base, change, "id", ["host", "scheme"], inputs.stamp())
    return done.withColumn("updated_at", format_utc(F.col("updated_at")))


@query(
    "source_delete",
    """
select c_custkey as id, c_name as host from customer
where c_custkey not in (select o_custkey from orders where o_custkey % 3 = 0)""",
)
def source_delete(spark, folder):
    """Every third customer with an order goes; the others stay."""
    base = read_table(spark, folder, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("host"))
    doomed = read_table(spark, folder, "orders").where(F.col("o_custkey") % 3 == 0).select(F.col("o_custkey").alias("id"))
    return upsert.delete(base, doomed, ["id"])


@query(
    "source_lookup",
    """
with wanted as (select distinct o_custkey * 2 as id from orders)
select id, c_name as host, case when c_custkey is null then 'ErrNotFound' end as error
from wanted left join customer on c_custkey = id""",
)
def source_lookup(spark, folder):
    base = read_table(spark, folder, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("host"))
    wanted = read_table(spark, folder, "orders").select((F.col("o_custkey") * 2).alias("id")).distinct()
    found, missing = upsert.lookup(base, wanted, "id")
    return found.withColumn("error", F.lit(None).cast("string")).unionByName(missing, allowMissingColumns=True)


@query(
    "tag_upsert",
    f"""
with terms as (
  select distinct doc_id, unnest([source, lang]) as name from documents),
stored as (select distinct source as name from documents where lang = 'fr'),
tags as (select name, case when name in (select name from stored) then 'tag-' || name else sha256(name) end as id
  from (select distinct name from terms)),
links as (select distinct doc_id, 'tag-' || source as tag_id from documents where lang = 'fr')
select 'tag' as kind, id, name as label from tags
union all
select 'link', sha256(doc_id || chr(31) || id), id from terms join tags using (name)
where not exists (select 1 from links l where l.doc_id = terms.doc_id and l.tag_id = tags.id)
union all
select 'link', sha256(doc_id || chr(31) || tag_id), tag_id from links""",
)
def tag_upsert(spark, folder):
    """Terms of all documents onto a tag table that knows the sources of French documents."""
    docs = read_table(spark, folder, "documents").select("doc_id", "source", "lang")
    french = docs.where("lang = 'fr'")
    now = inputs.stamp()
    tag_id = F.concat(F.lit("tag-"), F.col("source"))
    old_tags = french.select(tag_id.alias("id"), F.col("source").alias("name"), now.alias("created_at")).distinct()
    old_links = french.select(
        stable_id(F.col("doc_id"), tag_id).alias("id"), F.col("doc_id").alias("document_id"),
        tag_id.alias("tag_id"), now.alias("created_at"),
    )
    terms = docs.select(F.col("doc_id").alias("document_id"), F.explode(F.array("source", "lang")).alias("name"))
    all_tags, all_links = tags.link(terms, old_tags, old_links, now)
    return all_tags.select(F.lit("tag").alias("kind"), "id", F.col("name").alias("label")).unionByName(
        all_links.select(F.lit("link").alias("kind"), "id", F.col("tag_id").alias("label"))
    )


@query(
    "fk_orphans",
    """
select 'documents.doc_id->labels' as rule, doc_id::varchar as key, doc_id::varchar as detail from documents
where doc_id not in (select doc_id from labels)
union all
select 'lineitem.l_orderkey->orders', l_orderkey || '-' || l_linenumber, l_orderkey::varchar from lineitem
where l_orderkey not in (select o_orderkey from orders where o_orderstatus = 'F')
union all
select 'orders.o_custkey->customer', o_orderkey::varchar, o_custkey::varchar from orders
where o_custkey not in (select c_custkey from customer where c_acctbal >= 0)""",
)
def fk_orphans(spark, folder):
    docs, labels = read_table(spark, folder, "documents"), read_table(spark, folder, "labels")
    orders = read_table(spark, folder, "orders")
    lines = read_table(spark, folder, "lineitem").withColumn("id", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    solvent = read_table(spark, folder, "customer").where("c_acctbal >= 0")
    parts = [
        integrity.orphans(docs, labels, ReferenceRule("documents", "doc_id", "labels", "doc_id"), "doc_id"),
        integrity.orphans(
            lines, orders.where("o_orderstatus = 'F'"), ReferenceRule("lineitem", "l_orderkey", "orders", "o_orderkey")
        ),
        integrity.orphans(orders, solvent, ReferenceRule("orders", "o_custkey", "customer", "c_custkey"), "o_orderkey"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).drop("table")


@query(
    "constraint_report",
    f"""
with {_NEW_SOURCES}
select 'sources.active_domain' as rule, id as key, 'check' as detail from new_sources where active_domain not in (0, 1)
union all select 'sources.format', id, 'check' from new_sources where format not in ('json', 'yml', 'yaml', 'md')
union all select 'sources.unique(id)', id, 'rows=' || count(*) from new_sources group by id having count(*) > 1
union all select 'tags.unique(name)', source, 'rows=' || count(*) from documents group by source having count(*) > 1
union all select 'downloads.source_id->sources', 'd' || o_orderkey, 's' || o_custkey from orders
  where 's' || o_custkey not in (select id from new_sources)""",
)
def constraint_report(spark, folder):
    segment = F.col("c_mktsegment")
    sources = read_table(spark, folder, "customer").select(
        F.concat(F.lit("s"), F.floor(F.col("c_custkey") / 2).cast("string")).alias("id"),
        F.when(F.col("c_acctbal") < 0, 2).otherwise(1).alias("active_domain"),
        F.when(segment == "MACHINERY", "xml").when(segment == "BUILDING", "yaml").otherwise("json").alias("format"),
    )
    tag_rows = read_table(spark, folder, "documents").select(F.col("doc_id").alias("id"), F.col("source").alias("name"))
    downloads = read_table(spark, folder, "orders").select(
        F.concat(F.lit("d"), F.col("o_orderkey").cast("string")).alias("id"),
        F.concat(F.lit("s"), F.col("o_custkey").cast("string")).alias("source_id"),
        F.lit("{}").alias("headers"),
    )
    return integrity.integrity_report({"sources": sources, "tags": tag_rows, "downloads": downloads}).drop("table")


_LISTED = """
listed as (
  select 'o' || o_orderkey as id, 'h' || o_custkey % 50 || '.org' as host, o_orderdate as created_at from orders)"""


def _stored_sources(spark, folder):
    """Orders as stored sources: time stamps as text in both stored notations."""
    day = F.col("o_orderdate").cast("timestamp")
    stored = F.when(F.col("o_orderkey") % 2 == 0, format_utc(day)).otherwise(F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
    return read_table(spark, folder, "orders").select(
        F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("id"),
        F.concat(F.lit("h"), (F.col("o_custkey") % 50).cast("string"), F.lit(".org")).alias("host"),
        stored.alias("created_at"),
    )


@query(
    "source_listing",
    f"""
with {_LISTED}
select '{{"id":"' || id || '","host":"' || host || '","created_at":"' || strftime(created_at, '%Y-%m-%dT%H:%M:%SZ') || '"}}'
  as json from listed order by created_at desc, id""",
)
def source_listing(spark, folder):
    good, _ = listing.parse_times(_stored_sources(spark, folder), ["created_at"])
    return listing.json_rows(listing.newest_sources(good))


@query(
    "document_listing",
    """
select 'e' || event_id as id, case when event_id % 50 <> 0 then strftime(ts, '%Y-%m-%dT%H:%M:%SZ') end as indexed_at
from events""",
)
def document_listing(spark, folder):
    rows = read_table(spark, folder, "events").select(
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("id"),
        F.when(F.col("event_id") % 50 != 0, F.col("ts").cast("timestamp")).alias("indexed_at"),
    )
    return listing.newest_documents(rows).withColumn("indexed_at", format_utc(F.col("indexed_at")))


@query(
    "first_sources",
    f"with {_LISTED} select id, host from listed order by created_at desc, id limit 25",
)
def first_sources(spark, folder):
    good, _ = listing.parse_times(_stored_sources(spark, folder), ["created_at"])
    return listing.first_sources(good, 25).select("id", "host")


@query(
    "sources_of_hosts",
    f"with {_LISTED} select id, host from listed where host in ('h3.org', 'h7.org')",
)
def sources_of_hosts(spark, folder):
    return listing.of_hosts(_stored_sources(spark, folder), ["h3.org", "h7.org"]).select("id", "host")


_TABLE_NAMES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]


@query(
    "row_counts",
    " union all ".join(f"select '{name}' as \"table\", count(*) as rows from {name}" for name in _TABLE_NAMES),
)
def row_counts(spark, folder):
    return listing.row_counts({name: read_table(spark, folder, name) for name in _TABLE_NAMES})
