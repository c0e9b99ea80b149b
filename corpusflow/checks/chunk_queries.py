"""Tokens and chunks."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow import fixed
from corpusflow.checks import inputs
from corpusflow.checks.inputs import chunks_sql, tokens_sql
from corpusflow.checks.registry import query
from corpusflow.functions import language, tokens
from corpusflow.operators.chunks import broken_links, cut, token_chunks
from corpusflow.options import ChunkOptions
from corpusflow.session import materialize

OVERLAPPING = ChunkOptions(max_tokens=100, overlap=20)
FIXED = ChunkOptions(max_tokens=100)
WHOLE_MODEL = ChunkOptions(max_tokens=fixed.MODEL_MAX_TOKENS)

_COLUMNS = "document_id, pos, id, left_chunk_id, right_chunk_id, body, strlen(body)::int as byte_size, token_count"


def document_chunks(spark, folder, options):
    return token_chunks(inputs.documents(spark, folder), "doc_id", "text", options)


@query("token_count", f"select doc_id, len({tokens_sql('text')})::int as tokens from documents")
def token_count(spark, folder):
    return inputs.documents(spark, folder).select("doc_id", tokens.token_count(F.col("text")).alias("tokens"))


@query("chunk_fixed", f"with {chunks_sql('documents', 'doc_id', 'text', 100)} select {_COLUMNS} from chunks")
def chunk_fixed(spark, folder):
    return document_chunks(spark, folder, FIXED).drop("parent_chunk_id", "tokenizer")


@query("chunk_overlap", f"with {chunks_sql('documents', 'doc_id', 'text', 100, 20)} select {_COLUMNS} from chunks")
def chunk_overlap(spark, folder):
    return document_chunks(spark, folder, OVERLAPPING).drop("parent_chunk_id", "tokenizer")


@query(
    "chunk_to_model_limit",
    f"""
with {inputs.LONG_SQL}, {chunks_sql('long_documents', 'doc_id', 'text', fixed.MODEL_MAX_TOKENS)}
select document_id, pos, id, md5(body) as body_md5, strlen(body)::int as byte_size, token_count,
  'cl100k_base' as tokenizer, case when {inputs.french_sql('text')} >= 3 then 'fr' else 'en' end as natural_lang
from chunks join long_documents on doc_id = document_id""",
)
def chunk_to_model_limit(spark, folder):
    docs = inputs.long_documents(spark, folder).withColumn("natural_lang", language.heuristic(F.col("text")))
    made = token_chunks(docs, "doc_id", "text", WHOLE_MODEL, keep=["natural_lang"])
    return made.select(
        "document_id", "pos", "id", F.md5("body").alias("body_md5"), "byte_size", "token_count", "tokenizer",
        "natural_lang",
    )


@query(
    "chunk_links",
    f"""
with {chunks_sql('documents', 'doc_id', 'text', 100, 20)},
linked as (
  select *, lag(id) over w as want_left, lead(id) over w as want_right from chunks
  window w as (partition by document_id order by pos))
select count(*) as chunks, count(left_chunk_id) as left_links, count(right_chunk_id) as right_links,
  count(*) filter (where left_chunk_id is distinct from want_left or right_chunk_id is distinct from want_right) as broken
from linked""",
)
def chunk_links(spark, folder):
    made = materialize(
        document_chunks(spark, folder, OVERLAPPING).select("id", "left_chunk_id", "right_chunk_id"), "links"
    )
    broken = broken_links(made).select(F.lit(1).alias("broken"), F.lit(0).alias("chunk"), F.lit(0).alias("l"), F.lit(0).alias("r"))
    whole = made.select(
        F.lit(0).alias("broken"), F.lit(1).alias("chunk"),
        F.col("left_chunk_id").isNotNull().cast("int").alias("l"),
        F.col("right_chunk_id").isNotNull().cast("int").alias("r"),
    )
    return whole.unionByName(broken).agg(
        F.sum("chunk").alias("chunks"), F.sum("l").alias("left_links"), F.sum("r").alias("right_links"),
        F.sum("broken").alias("broken"),
    )


@query(
    "chunk_reassembly",
    """
select doc_id as document_id, md5(text) as text_md5, strlen(text)::int as bytes from documents where text <> ''""",
)
def chunk_reassembly(spark, folder):
    """Bodies without their overlap, joined in order, are the document again."""
    made = document_chunks(spark, folder, OVERLAPPING)
    own = F.when(F.col("pos") == 0, F.col("body")).otherwise(
        F.array_join(F.slice(tokens.tokens(F.col("body")), OVERLAPPING.overlap + 1, OVERLAPPING.max_tokens), "")
    )
    pieces = made.select("document_id", F.struct("pos", own.alias("own")).alias("piece"))
    joined = pieces.groupBy("document_id").agg(F.array_sort(F.collect_list("piece")).alias("pieces"))
    text = F.array_join(F.transform("pieces", lambda piece: piece["own"]), "")
    return joined.select("document_id", F.md5(text).alias("text_md5"), F.octet_length(text).alias("bytes"))


_MARK = "chr(10) || '## '"


@query(
    "chunk_heading",
    f"""
with split as (
  select doc_id, string_split(replace(text, chr(10), {_MARK}), {_MARK}) as parts from documents where text <> ''),
placed as (select *, unnest(range(len(parts))) as s from split),
sections as (
  select doc_id, s, {tokens_sql("case when s > 0 then '## ' else '' end || parts[s + 1] || case when s < len(parts) - 1 then chr(10) else '' end")} as tok
  from placed),
cuts as (select doc_id, s, tok, unnest(range(ceil(len(tok) / 100.0)::bigint)) as c from sections),
made as (
  select doc_id, tok[c * 100 + 1 : c * 100 + 100] as own,
    (row_number() over (partition by doc_id order by s, c) - 1)::int as pos, count(*) over (partition by doc_id) as k
  from cuts)
select doc_id as document_id, pos, sha256(doc_id || chr(31) || pos) as id, md5(array_to_string(own, '')) as body_md5,
  len(own)::int as token_count, case when pos < k - 1 then sha256(doc_id || chr(31) || (pos + 1)) end as right_chunk_id
from made""",
)
def chunk_heading(spark, folder):
    """Documents whose lines are headings, one chunk or more for each."""
    docs = inputs.documents(spark, folder).select("doc_id", F.replace("text", F.lit("\n"), F.lit("\n## ")).alias("text"))
    made = cut(docs, "doc_id", "text", ChunkOptions(max_tokens=100, strategy="heading"))
    return made.select("document_id", "pos", "id", F.md5("body").alias("body_md5"), "token_count", "right_chunk_id")


@query(
    "chunk_recursive",
    """
select doc_id as document_id, md5(text) as text_md5, 0::bigint as too_long, 0::bigint as miscounted
from documents where text <> ''""",
)
def chunk_recursive(spark, folder):
    """Packed paragraphs and sentences join to the document again; none is beyond the limit."""
    docs = inputs.documents(spark, folder)
    made = cut(docs, "doc_id", "text", ChunkOptions(max_tokens=60, strategy="recursive"))
    pieces = made.select(
        "document_id", F.struct("pos", "body").alias("piece"), (F.col("token_count") > 60).alias("long"),
        (F.octet_length("body") != F.col("byte_size")).alias("wrong"),
    )
    joined = pieces.groupBy("document_id").agg(
        F.array_sort(F.collect_list("piece")).alias("pieces"), F.count_if("long").alias("too_long"), F.count_if("wrong").alias("miscounted")
    )
    text = F.array_join(F.transform("pieces", lambda piece: piece["body"]), "")
    return joined.select("document_id", F.md5(text).alias("text_md5"), "too_long", "miscounted")
