"""URL parts, routing, file paths."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow.checks import inputs
from corpusflow.checks.inputs import uri_sql
from corpusflow.checks.registry import query
from corpusflow.functions import paths, urls
from corpusflow.functions.times import format_utc
from corpusflow.plans import parts
from corpusflow.sources.landing import source_rows
from corpusflow.sources.tables import read_table


@query(
    "sources_from_pages",
    f"""
select sha256(url) as id, url as raw_url, lower({uri_sql('url', 2)}) as scheme,
  regexp_replace({uri_sql('url', 4)}, '^.*@', '') as host, url_decode({uri_sql('url', 5)}) as path,
  {uri_sql('url', 7)} as query, 1 as active_domain, 'json' as format, '{inputs.STAMP_TEXT}' as created_at
from pages""",
)
def sources_from_pages(spark, folder):
    rows = source_rows(read_table(spark, folder, "pages"), "url", F.lit("json"), inputs.stamp())
    return rows.drop("author_email", "updated_at").withColumn("created_at", format_utc(F.col("created_at")))


@query(
    "source_routing",
    f"""
with {inputs.PAGE_URLS_SQL},
parsed as (
  select *, regexp_replace({uri_sql('raw_url', 4)}, '^.*@', '') as host, {uri_sql('raw_url', 5)} as path,
    raw_url not like ':%' as ok from page_urls),
cut as (select *, string_split(trim(path, '/'), '/') as seg from parsed),
judged as (
  select *, case when not ok then 'ErrInvalidURL'
    when host not in ('github.com', 'api.github.com') then 'ErrNotGitHubURL'
    when len(seg) < 2 then 'ErrInvalidGitHubURLFormat' end as repo_error from cut),
routed as (
  select *, case when repo_error is null then 'github' when ok and contains(path, '/wp-json/') then 'wp-json' end
    as source_type from judged)
select page_id, repo_error, case when repo_error is null then seg[1] end as owner,
  case when repo_error is null then seg[2] end as repo,
  case when repo_error is null then case when len(seg) >= 4 and seg[3] = 'tree' then seg[4] else 'main' end end as ref,
  source_type, case when source_type is null then 'ErrNoImporterCanHandle' end as error,
  source_type as importer,
  case when host in ('github.com', 'api.github.com') then 'github' else 'wp-json' end as stored_type
from routed""",
)
def source_routing(spark, folder):
    routed = urls.route_import(inputs.page_urls(spark, folder))
    return routed.select(
        "page_id", "repo_error", "owner", "repo", "ref", "source_type", "error",
        parts.source_type(F.col("raw_url")).alias("importer"),
        urls.stored_source_type(urls.host(F.col("raw_url"))).alias("stored_type"),
    )


_BLOBS = """
blobs as (
  select doc_id, 'o' || doc_id % 5 as owner, case doc_id % 6
    when 0 then 'https://github.com/o' || doc_id % 5 || '/r/blob/main/src/f' || doc_id || '.go'
    when 1 then 'https://github.com/o' || doc_id % 5 || '/r/blob/feature/new-' || doc_id || '/deep/file.txt'
    when 2 then 'https://github.com/o' || doc_id % 5 || '/r/tree/main/f' || doc_id
    when 3 then 'https://github.com/o' || doc_id % 5
    when 4 then 'https://github.com/o' || doc_id % 5 || '/r/blob/main/.gitignore'
    else 'https://github.com/o' || doc_id % 5 || '/r/blob/main/docs.v2/README' end as url
  from documents)"""


@query(
    "file_paths",
    f"""
with {_BLOBS},
p as (select *, doc_id % 6 as c from blobs),
f as (
  select *, case c when 0 then 'src/f' || doc_id || '.go' when 1 then 'new-' || doc_id || '/deep/file.txt'
    when 4 then '.gitignore' when 5 then 'docs.v2/README' else '' end as file_path from p)
select doc_id, file_path, regexp_extract(file_path, '(\\.[^./]*)$', 1) as extension,
  case when file_path = '' then '.' else string_split(file_path, '/')[-1] end as base_name,
  nullif(regexp_extract(file_path, '^(.*)/[^/]*$', 1), '') as directory,
  case when c <> 3 then owner end as owner, case when c <> 3 then 'r' end as repo,
  case c when 0 then 'main/src' when 1 then 'feature/new-' || doc_id || '/deep' when 4 then 'main'
    when 5 then 'main/docs.v2' end as branch,
  'json' as format
from f""",
)
def file_paths(spark, folder):
    docs = read_table(spark, folder, "documents").select("doc_id")
    number = F.col("doc_id").cast("string")
    base = F.concat(F.lit("https://github.com/o"), (F.col("doc_id") % 5).cast("string"))
    case = F.col("doc_id") % 6
    url = (
        F.when(case == 0, F.concat(base, F.lit("/r/blob/main/src/f"), number, F.lit(".go")))
        .when(case == 1, F.concat(base, F.lit("/r/blob/feature/new-"), number, F.lit("/deep/file.txt")))
        .when(case == 2, F.concat(base, F.lit("/r/tree/main/f"), number))
        .when(case == 3, base)
        .when(case == 4, F.concat(base, F.lit("/r/blob/main/.gitignore")))
        .otherwise(F.concat(base, F.lit("/r/blob/main/docs.v2/README")))
    )
    located = docs.withColumn("url", url).withColumn("file_path", paths.file_path(F.col("url")))
    path, u = F.col("file_path"), F.col("url")
    return located.select(
        "doc_id", "file_path", paths.extension(path).alias("extension"), paths.base_name(path).alias("base_name"),
        paths.directory(path).alias("directory"), paths.owner(u).alias("owner"), paths.repo(u).alias("repo"),
        paths.branch(u).alias("branch"), paths.stored_format(paths.extension(path)).alias("format"),
    )
