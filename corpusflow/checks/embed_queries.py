"""Embedding inputs, vectors, requests and responses."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow import fixed
from corpusflow.checks import inputs
from corpusflow.checks.chunk_queries import OVERLAPPING, document_chunks
from corpusflow.checks.inputs import chunks_sql
from corpusflow.checks.registry import query
from corpusflow.functions import text, vectors
from corpusflow.functions.tokens import token_count
from corpusflow.operators import embed as embedding
from corpusflow.sources.tables import read_table

CHUNKS = chunks_sql("documents", "doc_id", "text", 100, 20)
_INPUT = f"trim(replace(body, chr(10), ' '), '{text.TRIMMED}')"
_MODEL_NAMES = [name for name, _, _ in fixed.EMBEDDING_MODELS] + ["unknown-model"]
_MODELS = " union all ".join(
    f"select '{name}' as model, {dimension} as dimension, {limit} as max_tokens"
    for name, dimension, limit in fixed.EMBEDDING_MODELS
)


def hashed_sql(source: str, key: str, content: str, dimension: int = 64) -> str:
    """CTE ``hashed``: non-zero buckets of the hashing embedder."""
    return f"""
hash_words as (select {key} as id, unnest(string_split({content}, ' ')) as word from {source} where body <> ''),
hash_values as (select id, ('0x' || substr(md5(word), 1, 8))::ubigint as h from hash_words),
hashed as (
  select id, (h % {dimension})::int as bucket, sum(case when h >= 2147483648 then -1 else 1 end)::int as weight
  from hash_values group by all having weight <> 0)"""


@query(
    "embed_input",
    f"with {CHUNKS} select id, md5({_INPUT}) as input_md5, strlen({_INPUT})::int as bytes, body <> '' as embeddable from chunks",
)
def embed_input(spark, folder):
    cleaned = document_chunks(spark, folder, OVERLAPPING).select(
        "id", "body", text.embedding_input(F.col("body")).alias("input")
    )
    return cleaned.select(
        "id", F.md5("input").alias("input_md5"), F.octet_length("input").alias("bytes"),
        text.is_embeddable(F.col("body")).alias("embeddable"),
    )


@query("embed_hash", f"with {CHUNKS}, {hashed_sql('chunks', 'id', _INPUT)} select id, bucket, weight from hashed")
def embed_hash(spark, folder):
    made = embedding.embed(document_chunks(spark, folder, OVERLAPPING), embedding.hashing_embedder())
    sparse = made.where("error is null").select("id", F.posexplode("vector").alias("bucket", "weight"))
    return sparse.where("weight <> 0").withColumn("weight", F.col("weight").cast("int"))


@query(
    "tokens_by_model",
    f"""
with {CHUNKS}, models as ({_MODELS}),
used as (
  select {_MODEL_NAMES}[(document_id % 6 + 1)::int] as model, token_count from chunks)
select model, dimension, max_tokens, case when dimension is null then 'ErrUnsupportedModel' end as model_error,
  count(*) as inputs, sum(token_count)::bigint as tokens
from used left join models using (model) group by all""",
)
def tokens_by_model(spark, folder):
    chosen = document_chunks(spark, folder, OVERLAPPING).withColumn(
        "model", inputs._pick(_MODEL_NAMES, F.col("document_id") % 6)
    )
    return embedding.with_model(embedding.tokens_by_model(chosen))


@query(
    "token_limits",
    f"""
with {inputs.LONG_SQL}, counted as (select doc_id, len({inputs.tokens_sql('text')}) as tokens from long_documents),
models as ({_MODELS})
select doc_id, model, case when tokens > max_tokens then 'ErrTooManyTokens' end as error
from counted join models on model = {_MODEL_NAMES[:5]}[(doc_id % 5 + 1)::int]""",
)
def token_limits(spark, folder):
    counted = inputs.long_documents(spark, folder).select(
        "doc_id", inputs._pick(_MODEL_NAMES[:5], F.col("doc_id") % 5).alias("model"),
        token_count(F.col("text")).alias("tokens"),
    )
    return embedding.with_model(counted).select(
        "doc_id", "model", embedding.token_limit_error(F.col("tokens"), F.col("max_tokens")).alias("error")
    )


@query(
    "embed_requests",
    f"""
with {CHUNKS},
asked as (select id, {_INPUT} as input, {_MODEL_NAMES[:5]}[(document_id % 5 + 1)::int] as model from chunks)
select id, input as sent_input, model as sent_model, case when starts_with(model, 'text-embedding') then 'float' end
  as sent_encoding from asked""",
)
def embed_requests(spark, folder):
    asked = document_chunks(spark, folder, OVERLAPPING).select(
        "id", embedding.request_payload(F.col("body"), inputs._pick(_MODEL_NAMES[:5], F.col("document_id") % 5)).alias("payload")
    )
    read = F.from_json("payload", "struct<input:string,model:string,encoding_format:string>")
    return asked.select(
        "id", read["input"].alias("sent_input"), read["model"].alias("sent_model"),
        read["encoding_format"].alias("sent_encoding"),
    )


@query(
    "embed_responses",
    """
select vec_id, case vec_id % 10 when 3 then 'ErrNoEmbeddingData' when 7 then 'ErrDecode' end as error,
  case when vec_id % 10 not in (3, 7) then len(embedding)::int end as dimension,
  case when vec_id % 10 not in (3, 7) then true end as same
from embeddings""",
)
def embed_responses(spark, folder):
    given = read_table(spark, folder, "embeddings")
    vector = vectors.to_text(F.col("embedding"))
    case = F.col("vec_id") % 10
    response = (
        F.when(case == 3, '{"data":[],"model":"m"}')
        .when(case == 7, F.concat(F.lit('{"data":[{"embedding":'), vector))
        .otherwise(F.concat(F.lit('{"data":[{"embedding":'), vector, F.lit(',"index":0}],"model":"m"}')))
    )
    read = given.withColumn("got", embedding.parse_response(response))
    good = F.col("got.error").isNull()
    return read.select(
        "vec_id", F.col("got.error").alias("error"),
        F.when(good, F.size("got.vector")).alias("dimension"),
        F.when(good, F.col("got.vector") == F.col("embedding")).alias("same"),
    )


_DIMS = {64: "embedding_64", 32: "embedding_32"}


@query(
    "embedding_routing",
    """
select vec_id, case when vec_id % 4 in (0) then 64 end as in_64, case when vec_id % 4 = 1 then 32 end as in_32,
  case vec_id % 4 when 2 then 'ErrUnsupportedEmbeddingDim' when 3 then 'ErrNoEmbeddingVector' end as error
from embeddings""",
)
def embedding_routing(spark, folder):
    case = F.col("vec_id") % 4
    full = F.col("embedding")
    vector = (
        F.when(case == 0, full).when(case == 1, F.slice(full, 1, 32)).when(case == 2, F.slice(full, 1, 16))
    )
    routed = read_table(spark, folder, "embeddings").select("vec_id", vector.alias("v"))
    columns = vectors.by_dimension(F.col("v"), _DIMS)
    return routed.select(
        "vec_id",
        F.when(columns["embedding_64"].isNotNull(), F.size(columns["embedding_64"])).alias("in_64"),
        F.when(columns["embedding_32"].isNotNull(), F.size(columns["embedding_32"])).alias("in_32"),
        vectors.dimension_error(F.col("v"), _DIMS).alias("error"),
    )


@query(
    "embedding_codec",
    "select vec_id, len(embedding)::int as dimension, true as json_same, true as bracket_same from embeddings",
)
def embedding_codec(spark, folder):
    vector = F.col("embedding")
    return read_table(spark, folder, "embeddings").select(
        "vec_id",
        F.size(vectors.from_text(vectors.to_bracket_text(vector))).alias("dimension"),
        (vectors.from_text(vectors.to_text(vector)) == vector).alias("json_same"),
        (vectors.from_text(vectors.to_bracket_text(vector)) == vector).alias("bracket_same"),
    )
