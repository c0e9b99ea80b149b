"""Repository files: filter, content, language, metadata."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow import fixed
from corpusflow.checks import inputs
from corpusflow.checks.registry import query
from corpusflow.functions import language
from corpusflow.operators import files, ngrams
from corpusflow.options import FileOptions
from corpusflow.session import materialize
from corpusflow.sources import repository
from corpusflow.sources.tables import read_table

_SMALL = FileOptions(max_size=fixed.MAX_FILE_SIZE)
_DIRS = ["src", "node_modules/x", "rebuild", ".github", "docs", "lib/distance"]
_EXTS = [".md", ".PY", ".png", ".yaml", "", ".Rst", ".exe"]


@query(
    "file_filter",
    f"""
with t as (
  select doc_id, {_DIRS}[(doc_id % 6 + 1)::int] || '/f' || doc_id || {_EXTS}[(doc_id % 7 + 1)::int] as path,
    n_chars * 500 as size from documents),
entries as (
  select doc_id, path, 'blob' as type, size from t union all select doc_id, 'd' || doc_id || '.md', 'tree', 0 from t)
select doc_id, path, size,
  exists(select 1 from (select unnest({fixed.EXCLUDED_SUBSTRINGS}) as w) where contains(path, w)) as excluded,
  list_contains(['src', 'docs'], string_split(path, '/')[1]) and type = 'blob' and size <= {fixed.MAX_FILE_SIZE}
    and lower(regexp_extract(path, '(\\.[^./]*)$', 1)) in ('.md', '.py', '.yaml', '.rst') as wanted
from entries""",
)
def file_filter(spark, folder):
    docs = read_table(spark, folder, "documents")
    i = F.col("doc_id")
    path = F.concat(inputs._pick(_DIRS, i % 6), F.lit("/f"), i.cast("string"), inputs._pick(_EXTS, i % 7))
    blob = F.struct(path.alias("path"), F.lit("blob").alias("type"), (F.col("n_chars") * 500).alias("size"))
    tree = F.struct(
        F.concat(F.lit("d"), i.cast("string"), F.lit(".md")).alias("path"), F.lit("tree").alias("type"),
        F.lit(0).cast("bigint").alias("size"),
    )
    responses = docs.select("doc_id", F.to_json(F.struct(F.array(blob, tree).alias("tree"))).alias("body"))
    items = repository.tree_items(responses, keep=("doc_id",))
    return items.select(
        "doc_id", "path", "size", repository.paths.is_excluded(F.col("path")).alias("excluded"),
        (repository.is_wanted() & ~repository.is_too_large(_SMALL)).alias("wanted"),
    )


@query(
    "file_content",
    f"""
with {inputs.FILES_SQL}
select doc_id, error, content,
  case when error is null then case when ext = '.yaml' then 'yaml' else 'json' end end as format,
  case when error is null then case ext when '.py' then 'python' when '.js' then 'javascript' when '.sql' then 'sql'
    when '.go' then '' when '.html' then '' when '.json' then '' when '.yaml' then ''
    else case when {inputs.french_sql('content')} >= 3 then 'fr' else 'en' end end end as language
from file_contents""",
)
def file_content(spark, folder):
    done = files.transform(inputs.document_files(spark, folder), encoding="encoding")
    return done.select("doc_id", "error", "content", "format", "language")


@query(
    "file_metadata",
    f"""
with {inputs.FILES_SQL},
kv as (
  select doc_id, unnest([
    {{'key': 'file_path', 'meta': path}},
    {{'key': 'file_name', 'meta': doc_id || ext}},
    {{'key': 'file_extension', 'meta': ext}},
    {{'key': 'content_type', 'meta': case when ext in ('.py', '.js', '.go', '.html', '.json', '.yaml', '.sql')
      then 'code' else 'text' end}},
    {{'key': 'programming_language', 'meta': case ext when '.py' then 'python' when '.js' then 'javascript'
      when '.go' then 'go' when '.html' then 'html' when '.json' then 'json' when '.yaml' then 'yaml'
      when '.sql' then 'sql' end}},
    {{'key': 'natural_language', 'meta': case when ext in ('.md', '.txt', '.MD', '.xyz', '') then
      case when {inputs.french_sql('content')} >= 3 then 'fr' else 'en' end end}},
    {{'key': 'directory', 'meta': nullif(rtrim(dir, '/'), '')}},
    {{'key': 'repository', 'meta': '{{"branch":"' || rtrim('main/' || dir, '/') || '","owner":"' || owner || '","repo":"'
      || repo || '"}}'}},
    {{'key': 'file_size', 'meta': octet_length(encode(content))::varchar}},
    {{'key': 'line_count', 'meta': (len(content) - len(replace(content, chr(10), '')) + 1)::varchar}},
    {{'key': 'character_count', 'meta': octet_length(encode(content))::varchar}}
  ]) as e
  from file_contents where error is null)
select doc_id, e.key as key, e.meta as meta from kv where e.meta is not null""",
)
def file_metadata(spark, folder):
    done = files.transform(inputs.document_files(spark, folder), encoding="encoding")
    return done.select("doc_id", F.explode_outer("metadata").alias("key", "meta")).where("key is not null")


@query(
    "language_heuristic",
    f"""
select doc_id, lang, {inputs.french_sql('text')} as hits,
  case when {inputs.french_sql('text')} >= 3 then 'fr' else 'en' end as detected from documents""",
)
def language_heuristic(spark, folder):
    text = F.col("text")
    return inputs.documents(spark, folder).select(
        "doc_id", "lang", language.french_hits(text).alias("hits"), language.heuristic(text).alias("detected")
    )


_STOP = " union all ".join(
    f"select '{name}' as language, unnest({words}) as word" for name, words in language.STOP_WORDS.items()
)


@query(
    "language_profile",
    f"""
with stop as ({_STOP}),
words as (select doc_id, unnest(regexp_extract_all(lower(text), '\\p{{L}}+')) as word from documents),
scores as (
  select doc_id, language, count(*) as score from words join stop using (word) group by all),
best as (
  select doc_id, language, score from scores
  qualify row_number() over (partition by doc_id order by score desc, language desc) = 1)
select d.doc_id, d.lang, b.language as detected, coalesce(b.score, 0)::int as score
from documents d left join best b using (doc_id)""",
)
def language_profile(spark, folder):
    scored = language.with_profile(inputs.documents(spark, folder), "text")
    return scored.select("doc_id", "lang", "detected", F.array_max("scores")["score"].alias("score"))


_GRAMS = """list_filter(flatten([list_transform(range(1, length(b) - k + 2), lambda i: substr(b, i, k)) for k in [1, 2, 3]]), lambda g: g <> ' ')"""


@query(
    "language_ngrams",
    f"""
with said as (select doc_id, lang, unnest(regexp_extract_all(lower(text), '\\p{{L}}+')) as word from documents),
cut as (
  select doc_id, lang, times, unnest({_GRAMS}) as gram
  from (select doc_id, lang, ' ' || word || ' ' as b, count(*) as times from said group by all)),
own as (
  select doc_id, gram, row_number() over (partition by doc_id order by sum(times) desc, gram) - 1 as rank
  from cut group by doc_id, gram qualify rank < 300),
profiles as (
  select lang, gram, row_number() over (partition by lang order by sum(times) desc, gram) - 1 as place
  from cut where doc_id % 5 <> 0 group by lang, gram qualify place < 300),
saved as (
  select doc_id, lang, sum(300 - abs(rank - place)) as saved from own join profiles using (gram) group by all),
best as (select * from saved qualify row_number() over (partition by doc_id order by saved desc, lang) = 1),
whole as (select doc_id, count(*) * 300 as whole from own group by doc_id)
select d.doc_id, case when whole is not null then coalesce(b.lang, (select min(lang) from profiles)) end as language,
  (whole - coalesce(saved, 0))::bigint as distance
from documents d left join whole using (doc_id) left join best b using (doc_id)""",
)
def language_ngrams(spark, folder):
    """Documents by profiles learned from four fifths of them."""
    docs = inputs.documents(spark, folder).select("doc_id", "text", "lang")
    profiles = materialize(ngrams.learn_profiles(docs.where(F.col("doc_id") % 5 != 0), "text", "lang"), "profiles")
    return ngrams.detect(docs, "doc_id", "text", profiles)
