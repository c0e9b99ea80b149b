"""The shapes the operators read, derived from the given tables.

Each Spark derivation has its SQL counterpart. Irregular rows (missing keys, bad
dates, short URLs, ...) are spread over the whole table by the id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow import fixed
from corpusflow.sources.tables import read_table

STAMP_TEXT = "2024-06-01T00:00:00Z"


def stamp() -> Column:
    """The one time stamp of a run."""
    return F.lit("2024-06-01 00:00:00").cast("timestamp")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents for costly per-text work, dealt over the session's shuffle partitions."""
    return dealt(read_table(spark, folder, "documents"))


#: Texts repeated until they exceed the context of most models.
LONG_CHARS = 60000
LONG_SQL = f"long_documents as (select doc_id, repeat(text || chr(10), {LONG_CHARS} // (n_chars + 1) + 1) as text from documents)"


def long_documents(spark: SparkSession, folder: str) -> DataFrame:
    times = F.floor(F.lit(LONG_CHARS) / (F.col("n_chars") + 1)).cast("int") + 1
    return documents(spark, folder).select("doc_id", F.repeat(F.concat("text", F.lit("\n")), times).alias("text"))


def dealt(df: DataFrame) -> DataFrame:
    """The given tables are single files of one row group; their rows move once to use all cores."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


# -- URLs ------------------------------------------------------------------

def page_urls(spark: SparkSession, folder: str) -> DataFrame:
    """Page URLs, most of them rewritten to repository, API and post addresses."""
    pages = read_table(spark, folder, "pages").select("page_id", F.col("url").alias("page_url"))
    site = F.regexp_extract("page_url", "^[a-z]+://([^/?#]+)", 1)
    number = F.col("page_id").cast("string")
    url = (
        F.when(F.col("page_id") % 7 == 0, F.concat(F.lit("https://github.com/"), site, F.lit("/repo"), number))
        .when(
            F.col("page_id") % 7 == 1,
            F.concat(F.lit("https://github.com/"), site, F.lit("/repo/tree/v"), number, F.lit("/docs")),
        )
        .when(F.col("page_id") % 7 == 2, F.concat(F.lit("https://api.github.com/repos/"), site))
        .when(F.col("page_id") % 7 == 3, F.concat(F.lit("https://github.com/"), site))
        .when(
            F.col("page_id") % 7 == 4,
            F.concat(F.lit("https://me@"), site, F.lit(":8443/wp-json/wp/v2/posts/"), number, F.lit("?x=1#y")),
        )
        .when(F.col("page_id") % 7 == 5, F.concat(F.lit("://"), site, F.lit("/a")))
        .otherwise(F.col("page_url"))
    )
    return pages.select("page_id", url.alias("raw_url"))


PAGE_URLS_SQL = """
page_urls as (
  select page_id, case page_id % 7
    when 0 then 'https://github.com/' || site || '/repo' || page_id
    when 1 then 'https://github.com/' || site || '/repo/tree/v' || page_id || '/docs'
    when 2 then 'https://api.github.com/repos/' || site
    when 3 then 'https://github.com/' || site
    when 4 then 'https://me@' || site || ':8443/wp-json/wp/v2/posts/' || page_id || '?x=1#y'
    when 5 then '://' || site || '/a'
    else url end as raw_url
  from (select page_id, url, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) as site from pages))"""

URI = r"^(([^:/?#]+):)?(//([^/?#]*))?([^?#]*)(\?([^#]*))?(#(.*))?"


def uri_sql(url: str, group: int) -> str:
    return f"regexp_extract({url}, '{URI}', {group})"


# -- posts -----------------------------------------------------------------

def _escaped(text: Column) -> Column:
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def _quoted(text: Column) -> Column:
    return F.concat(F.lit('"'), text, F.lit('"'))


def post_columns() -> dict[str, Column]:
    """A document as a post response; some bodies are broken in one way each."""
    i = F.col("doc_id")
    number = i.cast("string")
    case = i % 16
    link = F.concat(F.lit("https://"), F.col("source"), F.lit(".example.org/posts/"), number)
    rendered = F.concat(
        F.lit("<h1>"), F.col("source"), F.lit("</h1>\n<p>"), _escaped(F.col("text")),
        F.lit("</p><p><a href='"), link, F.lit("'>"), F.col("source"), F.lit("</a></p>"),
    )
    content = (
        F.when(case == 2, F.lit('"plain"'))
        .when(case == 3, F.lit('{"raw":"none"}'))
        .when(case == 4, F.lit('{"rendered":[7.5]}'))
        .otherwise(F.to_json(F.struct(rendered.alias("rendered"))))
    )
    written = F.date_format(
        F.timestamp_seconds(F.lit(1672531200) + i * 3600), "yyyy-MM-dd'T'HH:mm:ss"
    )
    body = F.concat(
        F.lit('{"id":'), number,
        F.lit(',"link":'), _quoted(link),
        F.lit(',"date_gmt":'), _quoted(F.when(case == 5, "31 May, noon").otherwise(written)),
        F.lit(',"modified_gmt":'), F.when(case == 6, "null").otherwise(_quoted(written)),
        F.when(case == 1, "").otherwise(F.concat(F.lit(',"content":'), content)),
        F.lit(',"title":{"rendered":"  Post '), number, F.lit(' &amp; '), F.col("lang"), F.lit(' "}'),
        F.lit(',"excerpt":{"rendered":"<p>About <em>'), F.col("source"), F.lit('</em> in '), F.col("lang"),
        F.lit('</p>"},"author":'), (i % 7).cast("string"), F.lit('.9,"status":"publish","type":"post","slug":"post-'),
        number, F.lit('","featured_media":'),
        F.when(i % 3 == 0, _quoted((i % 100).cast("string"))).otherwise((i % 100).cast("string")),
        F.lit(',"categories":['), (i % 5).cast("string"), F.lit(","), (i % 11).cast("string"), F.lit("]"),
        F.lit(',"_embedded":{"wp:term":[[{"id":1,"name":'), _quoted(F.col("source")),
        F.lit('}],[{"id":2,"name":'), _quoted(F.col("lang")), F.lit("}]]}}"),
    )
    body = F.when(case == 7, F.concat(F.lit("["), body, F.lit("]"))).when(
        case == 8, F.concat(body, F.lit(","))
    ).otherwise(body)
    return {"raw_url": link, "body": body}


def document_posts(spark: SparkSession, folder: str) -> DataFrame:
    """Every document as a post response."""
    return documents(spark, folder).select("doc_id", *[column.alias(name) for name, column in post_columns().items()])


def collapsed_sql(text: str) -> str:
    return rf"trim(regexp_replace({text}, '[ \t\n\r\f\x0B]+', ' ', 'g'), ' ')"


POSTS_SQL = f"""
posts as (
  select doc_id, source, lang, text, doc_id % 16 as c,
    'https://' || source || '.example.org/posts/' || doc_id as link,
    strftime(timestamp '2023-01-01' + to_hours(doc_id::int), '%Y-%m-%dT%H:%M:%S') as written
  from documents),
post_content as (
  select *,
    case when c in (7, 8, 1) then 'ErrCannotTransformWPDownload' when c = 2 then 'ErrContentFieldNotObject'
      when c = 3 then 'ErrNoRenderedContent' when c = 4 then 'ErrRenderedContentNotString'
      when c = 5 then 'ErrParseDate' end as error,
    '# ' || source || case when {collapsed_sql('text')} = '' then '' else chr(10) || chr(10) || {collapsed_sql('text')} end
      || chr(10) || chr(10) || '[' || source || '](' || link || ')' as full_content
  from posts),
post_documents as (
  select *, case when error is null then full_content end as content from post_content)"""


# -- repository files ------------------------------------------------------

FILE_EXTENSIONS = [".md", ".txt", ".py", ".js", ".go", ".html", ".json", ".yaml", ".sql", ".MD", ".xyz", ""]
FILE_DIRECTORIES = ["", "src/", "src/lib/", "docs/"]


def _pick(values: list[str], index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def file_columns() -> dict[str, Column]:
    """A document as a repository file download, some base64, some without the hash header."""
    i = F.col("doc_id")
    ext = _pick(FILE_EXTENSIONS, i % 12)
    path = F.concat(_pick(FILE_DIRECTORIES, i % 4), i.cast("string"), ext)
    url = F.concat(
        F.lit("https://github.com/o"), (i % 5).cast("string"), F.lit("/r"), (i % 9).cast("string"),
        F.lit("/blob/main/"), path,
    )
    plain = F.when(ext == ".html", F.concat(F.lit("<p>"), _escaped(F.col("text")), F.lit("</p>"))).otherwise(
        F.col("text")
    )
    encoding = F.when(i % 5 == 0, "base64").otherwise("utf-8")
    header = F.when(i % 17 == 0, "x-github-sha").otherwise("X-GitHub-SHA")
    return {
        "raw_url": url,
        "body": F.when(encoding == "base64", F.base64(plain.cast("binary"))).otherwise(plain),
        "encoding": encoding,
        "headers": F.concat(F.lit('{"Content-Type":["text/plain"],"'), header, F.lit('":["abc"]}')),
    }


def document_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every document as a repository file download."""
    return documents(spark, folder).select("doc_id", *[column.alias(name) for name, column in file_columns().items()])


_LABELS = {".txt": "", ".py": "python", ".js": "javascript", ".go": "go", ".json": "json", ".yaml": "yaml"}
_FENCED = " ".join(f"when '{ext}' then '{label}'" for ext, label in _LABELS.items())

FILES_SQL = f"""
files as (
  select doc_id, text, source, lang,
    {FILE_EXTENSIONS}[(doc_id % 12 + 1)::int] as ext,
    {FILE_DIRECTORIES}[(doc_id % 4 + 1)::int] as dir
  from documents),
file_paths as (
  select *, dir || doc_id || ext as path, 'o' || doc_id % 5 as owner, 'r' || doc_id % 9 as repo,
    case when doc_id % 17 = 0 then 'ErrCannotTransformDownload' end as error
  from files),
file_contents as (
  select *,
    'https://github.com/' || owner || '/' || repo || '/blob/main/' || path as raw_url,
    case when error is not null then null
      when ext = '.html' then {collapsed_sql('text')}
      when ext in ('.txt', '.py', '.js', '.go', '.json', '.yaml')
        then '```' || case ext {_FENCED} end || chr(10) || text || chr(10) || '```'
      else text end as content
  from file_paths)"""


def french_sql(text: str) -> str:
    """Count of French indicators, ``des`` twice."""
    return "(" + " + ".join(f"contains(lower({text}), '{word}')::int" for word in fixed.FRENCH_INDICATORS) + ")"


# -- tokens and chunks -----------------------------------------------------

TOKENS = r"[^\r\n\p{L}\p{N}]?\p{L}+|\p{N}{1,3}| ?[^ \t\n\r\f\x0B\p{L}\p{N}]+[\r\n]*|[ \t\n\r\f\x0B]+"


def tokens_sql(text: str) -> str:
    return f"regexp_extract_all({text}, '{TOKENS}')"


def chunks_sql(source: str, key: str, text: str, size: int, overlap: int = 0, keep: str = "") -> str:
    """CTE ``chunks`` over a relation, same columns as the chunk operator."""
    step = size - overlap
    extra = f"{keep}, " if keep else ""
    return f"""
chunk_tokens as (
  select {extra}{key} as document_id, {tokens_sql(text)} as tok from {source} where {text} <> ''),
chunk_totals as (
  select *, case when len(tok) <= {size} then 1 else ceil((len(tok) - {size}) / {step}.0)::int + 1 end as k
  from chunk_tokens),
chunk_positions as (select *, unnest(range(k))::int as pos from chunk_totals),
chunks as (
  select {extra}document_id, pos,
    sha256(document_id || chr(31) || pos) as id,
    case when pos > 0 then sha256(document_id || chr(31) || (pos - 1)) end as left_chunk_id,
    case when pos < k - 1 then sha256(document_id || chr(31) || (pos + 1)) end as right_chunk_id,
    array_to_string(tok[pos * {step} + 1 : pos * {step} + {size}], '') as body,
    least({size}, len(tok) - pos * {step})::int as token_count
  from chunk_positions)"""


# -- downloads over time ---------------------------------------------------

def event_downloads(spark: SparkSession, folder: str) -> DataFrame:
    """Events as downloads: the user is the source; some are undated."""
    events = read_table(spark, folder, "events")
    return events.select(
        F.format_string("d%010d", "event_id").alias("id"),
        F.concat(F.lit("s"), F.col("user_id").cast("string")).alias("source_id"),
        F.col("ts").cast("timestamp").alias("attempted_at"),
        F.when(F.col("event_id") % 50 != 0, F.col("ts").cast("timestamp")).alias("downloaded_at"),
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status_code"),
        F.lit("{}").alias("headers"),
        F.col("props").alias("body"),
    )


DOWNLOADS_SQL = """
downloads as (
  select printf('d%010d', event_id) as id, 's' || user_id as source_id, ts as attempted_at,
    case when event_id % 50 <> 0 then ts end as downloaded_at,
    case when event_type = 'error' then 500 else 200 end as status_code, '{}' as headers, props as body
  from events)"""
