"""Landed responses: listing pages, items, repositories, outcome of an import."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow.checks import inputs
from corpusflow.checks.registry import query
from corpusflow.operators import outcome
from corpusflow.sources import landing, repository
from corpusflow.sources.tables import read_table

# A site is a user, a page the user's events within one block of 1,000 event ids.
# Some pages end the listing or fail; errors carry an id that is no number.
_PAGES = """
listed as (
  select event_id, user_id, 'https://s' || user_id || '.org/wp-json/wp/v2/posts' as base_url,
    ((event_id // 1000 + 1) * case when user_id % 2 = 0 then 150 else 1 end)::int as page, event_type from events),
pages as (
  select base_url, page, user_id, case
    when user_id % 10 = 3 and page >= 8 then 400 when user_id % 10 = 5 and page = 4 then 500 else 200 end as status_code,
    user_id % 10 = 7 and page = 2 as garbled, user_id % 10 = 9 and page = 6 as blank
  from (select distinct base_url, page, user_id from listed)),
ends as (select base_url, min(page) as last from pages where status_code = 400 or blank group by base_url),
live as (
  select p.*, case when status_code <> 200 then 'ErrUnexpectedStatusCode' when garbled then 'ErrDecode' end as error
  from pages p left join ends e using (base_url) where e.last is null or p.page < e.last)"""


def listing_pages(spark, folder):
    events = read_table(spark, folder, "events")
    # Some listings go on beyond page 1000.
    page = ((F.floor(F.col("event_id") / 1000) + 1) * F.when(F.col("user_id") % 2 == 0, 150).otherwise(1)).cast("int")
    entry = F.when(
        F.col("event_type") == "error", F.concat(F.lit('{"id":"x'), F.col("event_id").cast("string"), F.lit('"}'))
    ).otherwise(F.concat(F.lit('{"id":'), F.col("event_id").cast("string"), F.lit(',"title":{"rendered":"t"}}')))
    listed = events.select(
        "user_id", page.alias("page"), F.struct("event_id", entry.alias("entry")).alias("item")
    )
    body = F.concat(
        F.lit("["), F.array_join(F.transform(F.array_sort(F.collect_list("item")), lambda i: i["entry"]), ","), F.lit("]")
    )
    pages = listed.groupBy("user_id", "page").agg(body.alias("body"))
    digit = F.col("user_id") % 10
    return pages.select(
        F.concat(F.lit("https://s"), F.col("user_id").cast("string"), F.lit(".org/wp-json/wp/v2/posts")).alias("base_url"),
        "page",
        F.when((digit == 3) & (F.col("page") >= 8), 400)
        .when((digit == 5) & (F.col("page") == 4), 500)
        .otherwise(200)
        .alias("status_code"),
        F.when((digit == 7) & (F.col("page") == 2), "<html>")
        .when((digit == 9) & (F.col("page") == 6), "[]")
        .otherwise(F.col("body"))
        .alias("body"),
    )


@query(
    "listing_scan",
    f"""
with {_PAGES}
select 'item' as kind, base_url, page, event_id as item_id, base_url || '/' || event_id as detail
from listed join live using (base_url, page) where error is null and event_type <> 'error'
union all select 'reject', base_url, page, null, error from live where error is not null""",
)
def listing_scan(spark, folder):
    scanned = landing.listing_ids(listing_pages(spark, folder))
    items = scanned.items.select(F.lit("item").alias("kind"), "base_url", "page", "item_id", F.col("item_url").alias("detail"))
    rejects = scanned.rejects.select(
        F.lit("reject").alias("kind"), "base_url", "page", F.lit(None).cast("bigint").alias("item_id"),
        F.col("error").alias("detail"),
    )
    return items.unionByName(rejects)


def event_items(spark, folder):
    """Events as (listed items, item responses): some unanswered, some failed, some no JSON."""
    events = read_table(spark, folder, "events")
    base = F.concat(F.lit("https://s"), F.col("user_id").cast("string"), F.lit(".org/posts"))
    url = F.concat_ws("/", base, F.col("event_id").cast("string"))
    items = events.select(base.alias("base_url"), F.col("event_id").alias("item_id"), url.alias("item_url"))
    answered = events.where("event_type <> 'view' or value >= 5")
    responses = answered.select(
        url.alias("url"),
        F.col("ts").cast("timestamp").alias("attempted_at"),
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status_code"),
        F.create_map(F.lit("Content-Type"), F.array(F.lit("application/json"))).alias("headers"),
        F.when(F.col("value") < 2, "<html>").otherwise(F.col("props")).alias("body"),
    )
    return items, responses


_ITEMS = """
items as (
  select event_id, user_id, 'https://s' || user_id || '.org/posts' as base_url,
    'https://s' || user_id || '.org/posts/' || event_id as item_url, ts, props,
    case when event_type = 'view' and value < 5 then 'ErrNoResponse'
      when event_type = 'error' then 'ErrUnexpectedPostStatusCode' when value < 2 then 'ErrDecode' end as error
  from events)"""


@query(
    "item_fetch",
    f"""
with {_ITEMS}
select 'source' as kind, sha256(item_url) as id, item_url as detail from items where error is null
union all
select 'download', sha256(sha256(item_url) || chr(31) || sha256(props)),
  strftime(ts, '%Y-%m-%dT%H:%M:%SZ') || ' {{"Content-Type":["application/json"]}} ' || props from items where error is null
union all
select 'reject', item_url, error from items where error is not null""",
)
def item_fetch(spark, folder):
    items, responses = event_items(spark, folder)
    got = landing.import_items(items, responses, inputs.stamp())
    stamped = F.date_format("downloaded_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return (
        got.sources.select(F.lit("source").alias("kind"), "id", F.col("raw_url").alias("detail"))
        .unionByName(
            got.downloads.select(
                F.lit("download").alias("kind"), "id", F.concat_ws(" ", stamped, "headers", "body").alias("detail")
            )
        )
        .unionByName(
            got.rejects.select(F.lit("reject").alias("kind"), F.col("item_url").alias("id"), F.col("error").alias("detail"))
        )
    )


@query(
    "import_summary",
    f"""
with {_ITEMS}
select base_url, count(*) as total, count(error) as failed, count(*) - count(error) as ok,
  arg_min(error, event_id) filter (where error is not null) as first_error,
  arg_max(item_url, event_id) filter (where error is null) as last_ok,
  case when count(*) = count(error) then 'failed' when count(error) > 0 then 'ErrImportCompleted' else 'ok' end as outcome
from items group by base_url""",
)
def import_summary(spark, folder):
    items, responses = event_items(spark, folder)
    return outcome.summary(landing.fetched_items(items, responses), "base_url", "item_id", "item_url")


# Documents as repository files: one repository per source, sizes by characters.
_REPO = """
repo as (
  select doc_id, text, source as repo, 'docs/d' || doc_id || case doc_id % 5 when 0 then '.md' when 1 then '.yaml'
    when 2 then '.png' when 3 then '.py' else '.TXT' end as path, doc_id % 5 as c, lang,
    n_chars as size, md5(text) as sha from documents),
kept as (
  select *, 'https://github.com/acme/' || repo || '/blob/main/' || path as file_url,
    case lang when 'es' then 'ErrNoResponse' when 'de' then 'ErrGitHubAPIRequestFailed' end as error
  from repo where c <> 2)"""


def repository_files(spark, folder):
    """Documents as (tree entries, content responses)."""
    docs = inputs.documents(spark, folder)
    i = F.col("doc_id")
    path = F.concat(F.lit("docs/d"), i.cast("string"), inputs._pick([".md", ".yaml", ".png", ".py", ".TXT"], i % 5))
    base = docs.select(
        "doc_id", F.lit("acme").alias("owner"), F.col("source").alias("repo"), F.lit("main").alias("ref"),
        path.alias("path"), "text", "n_chars", "lang",
    )
    trees = base.select(
        "owner", "repo", "ref", "path", F.lit("blob").alias("type"), F.md5("text").alias("sha"),
        F.col("n_chars").alias("size"),
    )
    plain = i % 3 == 0
    contents = base.where("lang <> 'es'").select(
        "owner", "repo", "ref", "path",
        F.when(F.col("lang") == "de", 404).otherwise(200).alias("status_code"),
        F.lit(None).cast("timestamp").alias("attempted_at"),
        F.when(plain, F.col("text")).otherwise(F.base64(F.col("text").cast("binary"))).alias("content"),
        F.when(plain, "utf-8").otherwise("base64").alias("encoding"),
    )
    return trees, contents


@query(
    "repository_import",
    f"""
with {_REPO}
select 'source' as kind, sha256(file_url) as id, file_url || ' ' || case c when 1 then 'yaml' else 'json' end as detail
from kept where error is null
union all
select 'download', sha256(sha256(file_url) || chr(31) || sha256(text)),
  '{{"Content-Type":["text/plain"],"X-GitHub-SHA":["' || sha || '"]}} ' || md5(text) from kept where error is null
union all
select 'reject', repo || '/' || path, error from kept where error is not null""",
)
def repository_import(spark, folder):
    trees, contents = repository_files(spark, folder)
    got = repository.import_files(trees, contents, inputs.stamp())
    return (
        got.sources.select(F.lit("source").alias("kind"), "id", F.concat_ws(" ", "raw_url", "format").alias("detail"))
        .unionByName(
            got.downloads.select(
                F.lit("download").alias("kind"), "id", F.concat_ws(" ", "headers", F.md5("body")).alias("detail")
            )
        )
        .unionByName(
            got.rejects.select(
                F.lit("reject").alias("kind"), F.concat_ws("/", "repo", "path").alias("id"), F.col("error").alias("detail")
            )
        )
    )
