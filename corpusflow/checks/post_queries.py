"""Posts: validity, content, dates, metadata, terms, HTML."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow.checks import inputs
from corpusflow.checks.registry import query
from corpusflow.functions import text, times
from corpusflow.functions.ids import stable_id
from corpusflow.functions.markdown import html_to_markdown
from corpusflow.operators import metadata, posts
from corpusflow.sources.tables import read_table


@query(
    "post_body_validity",
    f"""
with {inputs.POSTS_SQL}
select doc_id, c not in (1, 7, 8) as is_post,
  case when c in (1) then 'ErrNoContentField' when c in (2, 3, 4) then error end as content_error,
  c = 5 as bad_date from posts join post_documents using (doc_id, c)""",
)
def post_body_validity(spark, folder):
    bodies = posts.with_parsed(inputs.document_posts(spark, folder), F.col("body"), "post")
    post = F.col("post")
    # Only JSON objects have a content error; a body that is none is no post at all.
    return bodies.select(
        "doc_id",
        posts.is_post(post).alias("is_post"),
        F.when(post.isNotNull(), posts.content_error(post)).alias("content_error"),
        (posts.date_error(post).isNotNull() & post.isNotNull()).alias("bad_date"),
    )


@query(
    "post_content",
    f"""
with {inputs.POSTS_SQL}
select doc_id, error, content,
  case when error is null then written || 'Z' end as published_at,
  case when error is null and c <> 6 then written || 'Z' end as modified_at,
  case when error is null then 'json' end as format
from post_documents""",
)
def post_content(spark, folder):
    done = posts.transform(inputs.document_posts(spark, folder))
    return done.select(
        "doc_id", "error", "content",
        times.format_utc(F.col("published_at")).alias("published_at"),
        times.format_utc(F.col("modified_at")).alias("modified_at"), "format",
    )


@query(
    "post_metadata",
    f"""
with {inputs.POSTS_SQL},
kv as (
  select doc_id, unnest([
    {{'key': 'document_title', 'meta': 'Post ' || doc_id || ' &amp; ' || lang}},
    {{'key': 'document_description', 'meta': 'About _' || source || '_ in ' || lang}},
    {{'key': 'canonical_url', 'meta': link}},
    {{'key': 'status', 'meta': 'publish'}},
    {{'key': 'post_type', 'meta': 'post'}},
    {{'key': 'slug', 'meta': 'post-' || doc_id}},
    {{'key': 'links_count', 'meta': len(regexp_extract_all(content, '\\[([^\\]]*)\\]\\([^\\)]*\\)'))::varchar}},
    {{'key': 'author_id', 'meta': (doc_id % 7)::varchar}},
    {{'key': 'featured_media', 'meta': case when doc_id % 3 <> 0 then (doc_id % 100)::varchar end}},
    {{'key': 'categories', 'meta': '[' || doc_id % 5 || ',' || doc_id % 11 || ']'}}
  ]) as e
  from post_documents where error is null)
select sha256(sha256(link) || chr(31) || e.key) as id, sha256(link) as document_id, e.key as key, e.meta as meta,
  '{inputs.STAMP_TEXT}' as created_at
from kv join posts using (doc_id) where e.meta is not null""",
)
def post_metadata(spark, folder):
    done = posts.transform(inputs.document_posts(spark, folder))
    rows = metadata.long_rows(
        done.withColumn("document_id", stable_id("raw_url")), "document_id", "metadata", inputs.stamp()
    )
    return rows.withColumn("created_at", times.format_utc(F.col("created_at")))


@query(
    "post_terms",
    f"""
with {inputs.POSTS_SQL}
select doc_id, unnest([source, lang]) as term from posts where c not in (7, 8)""",
)
def post_terms(spark, folder):
    bodies = posts.with_parsed(inputs.document_posts(spark, folder), F.col("body"), "post")
    return bodies.select("doc_id", F.explode(posts.terms(F.col("post"))).alias("term"))


@query(
    "link_count",
    r"""
select page_id, len(regexp_extract_all(
  regexp_replace(html, '<a href="([^"]*)">([^<]*)</a>', '[\2](\1)', 'g'), '\[([^\]]*)\]\([^\)]*\)'))::int as links
from pages""",
)
def link_count(spark, folder):
    pages = inputs.dealt(read_table(spark, folder, "pages"))
    marked = F.regexp_replace("html", '<a href="([^"]*)">([^<]*)</a>', "[$2]($1)")
    return pages.select("page_id", text.link_count(marked).alias("links"))


# The pages hold headings, paragraphs, flat lists of links and a bold line with a
# break, many unclosed, so a chain of replacements does for them what the converter
# does in general. chr(1) ends a block, chr(2) starts a list item.
_MARKDOWN = r"""
bodies as (
  select page_id, regexp_replace(regexp_replace(html, '(?s)^.*</head>', ''), '(?s)<!--.*?-->', '', 'g') as h from pages),
items as (
  select page_id, regexp_replace(h, '<li><a href="([^"]*)">([^<]*)</a></li>',
    chr(1) || chr(2) || '* [\2](\1)' || chr(1), 'g') as h from bodies),
bold as (
  select page_id, regexp_replace(h, '<b>[ \n]*([^<]*?)[ \n]*<br>', '**\1**', 'g') as h from items),
heads as (
  select page_id, regexp_replace(h, '<h1>[ \n]*([^<]*?)[ \n]*</h1>', chr(1) || '# \1' || chr(1), 'g') as h from bold),
flat as (
  select page_id, regexp_replace(h, '</?(html|body|nav|ul|div|article|footer|p)( [^>]*)?>', chr(1), 'g') as h from heads),
plain as (
  select page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(h,
    '&quot;', '"', 'g'), '&copy;', '©', 'g'), '&middot;', '·', 'g'), '&amp;?', '&', 'g') as h from flat),
blocks as (
  select page_id, list_filter(list_transform(string_split(h, chr(1)),
    lambda b: trim(regexp_replace(b, '[ \t\n\r\f\x0B]+', ' ', 'g'), ' ')), lambda b: b <> '') as bs from plain),
joined as (
  select page_id, replace(replace(array_to_string(bs, chr(10) || chr(10)), chr(10) || chr(10) || chr(2), chr(10)), chr(2), '')
    as markdown from blocks)"""


@query(
    "html_to_markdown",
    f"""
with {_MARKDOWN}
select page_id, markdown, len(regexp_extract_all(markdown, '\\[([^\\]]*)\\]\\([^\\)]*\\)'))::int as links,
  strlen(markdown)::int as bytes from joined""",
)
def html_markdown(spark, folder):
    pages = inputs.dealt(read_table(spark, folder, "pages"))
    converted = pages.select("page_id", html_to_markdown(F.col("html")).alias("markdown"))
    return converted.withColumns(
        {"links": text.link_count(F.col("markdown")), "bytes": text.byte_size(F.col("markdown"))}
    )


@query(
    "time_formats",
    """
with raw as (
  select o_orderkey, case o_orderkey % 4
    when 0 then strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') when 1 then strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
    when 2 then strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S+02:00') else 'unknown' end as stored
  from orders)
select o_orderkey, stored, case o_orderkey % 4 when 3 then 'ErrUnsupportedTimestampFormat' end as error,
  case o_orderkey % 4 when 3 then null
    when 2 then strftime(o_orderdate - interval 2 hour, '%Y-%m-%dT%H:%M:%SZ')
    else strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') end as parsed
from raw join orders using (o_orderkey)""",
)
def time_formats(spark, folder):
    day = F.col("o_orderdate").cast("timestamp")
    case = F.col("o_orderkey") % 4
    raw = (
        F.when(case == 0, times.format_utc(day))
        .when(case == 1, F.date_format(day, times.SQL_FORMAT))
        .when(case == 2, F.concat(F.date_format(day, times.POST_FORMAT), F.lit("+02:00")))
        .otherwise("unknown")
    )
    stored = read_table(spark, folder, "orders").select("o_orderkey", raw.alias("stored"))
    return stored.select(
        "o_orderkey", "stored", times.stored_time_error(F.col("stored")).alias("error"),
        times.format_utc(times.parse_stored_time(F.col("stored"))).alias("parsed"),
    )
