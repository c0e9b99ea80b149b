"""Embeddings of chunks through an injected model function."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow import fixed
from corpusflow.functions import text, vectors
from corpusflow.functions.ids import stable_id
from corpusflow.functions.tokens import token_count
from corpusflow.workers import ship_by_value

Vectors = list[list[float]] | np.ndarray


@dataclass(frozen=True)
class Embedder:
    """A model: its name, limits and the function from texts to vectors."""

    model: str
    dimension: int
    max_tokens: int
    embed_fn: Callable[[list[str]], Vectors]
    batch_size: int = 256
    #: Tokens of one request; None is what one text may have.
    request_tokens: int | None = None
    #: Further tries of a request that fails, and seconds before the first; each pause is twice the one before.
    retries: int = 0
    pause: float = 1.0


def registered(model: str, embed_fn: Callable[[list[str]], Vectors]) -> Embedder:
    for name, dimension, max_tokens in fixed.EMBEDDING_MODELS:
        if name == model:
            return Embedder(name, dimension, max_tokens, embed_fn)
    raise ValueError(f"ErrUnsupportedModel: {model}")


def model_table(spark: SparkSession) -> DataFrame:
    """The five known models; a fixed size, so joins broadcast it."""
    return spark.createDataFrame(fixed.EMBEDDING_MODELS, "model string, dimension int, max_tokens int")


def with_model(df: DataFrame, model: str = "model") -> DataFrame:
    """Add dimension, max_tokens and an error for unknown models."""
    models = model_table(df.sparkSession).withColumnRenamed("model", model)
    return df.join(F.broadcast(models), model, "left").withColumn(
        "model_error", F.when(F.col("dimension").isNull(), "ErrUnsupportedModel")
    )


def _word_hash(word: str) -> int:
    return int(hashlib.md5(word.encode("utf-8")).hexdigest()[:8], 16)


def hashing_embedder(model: str = "hashing-64", dimension: int = 64, max_tokens: int = 8191) -> Embedder:
    """Offline stand-in for a model: signed word counts in hash buckets.

    Bucket and sign come from the first 32 bits of the word's MD5: bucket is the
    value modulo the dimension, the sign its top bit.
    """

    def embed_fn(texts: list[str]) -> Vectors:
        out = np.zeros((len(texts), dimension), dtype=np.float32)
        words = [content.split(" ") for content in texts]
        known = {word: _word_hash(word) for word in set().union(*words)}
        for row, content in enumerate(words):
            hashes = np.fromiter((known[word] for word in content), dtype=np.int64)
            signs = np.where(hashes >> 31, -1.0, 1.0)
            out[row] = np.bincount(hashes % dimension, weights=signs, minlength=dimension)
        return out

    return Embedder(model, dimension, max_tokens, embed_fn, batch_size=1024, request_tokens=1 << 20)


def requests(counts: list[int], embedder: Embedder) -> Iterator[tuple[int, int]]:
    """Begin and end of consecutive texts that go into one request: as many as its tokens and its size allow."""
    budget = embedder.request_tokens or embedder.max_tokens
    begin, held = 0, 0
    for at, count in enumerate(counts):
        if at > begin and (held + count > budget or at - begin == embedder.batch_size):
            yield begin, at
            begin, held = at, 0
        held += count
    if begin < len(counts):
        yield begin, len(counts)


def _answers(embedder: Embedder, batch: list[str]) -> tuple[list, list]:
    """Vectors and reasons for a request, after its retries; one that fails, or answers another number, is asked text by text."""
    found, reason = None, None
    for turn in range(embedder.retries + 1):
        try:
            found, reason = embedder.embed_fn(batch), "ErrEmbeddingCount"
            break
        except Exception as failure:
            reason = f"ErrEmbedding: {type(failure).__name__}"
        if turn < embedder.retries:
            time.sleep(embedder.pause * 2**turn)
    if found is not None and len(found) == len(batch):
        # Rows of one array, or arrays of their own where lengths differ.
        return [np.asarray(v, np.float32) for v in found], [None] * len(batch)
    if len(batch) == 1:
        return [None], [reason]
    parts = [_answers(embedder, [single]) for single in batch]
    return [v for vectors, _ in parts for v in vectors], [r for _, reasons in parts for r in reasons]


def _vector_column(rows: list[np.ndarray | None]) -> pa.Array:
    sizes = [0 if v is None else len(v) for v in rows]
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
    flat = [v for v in rows if v is not None]
    values = pa.array(np.concatenate(flat) if flat else np.zeros(0, np.float32), pa.float32())
    return pa.ListArray.from_arrays(offsets, values, mask=pa.array([v is None for v in rows]))


def embed(chunks: DataFrame, embedder: Embedder, key: str = "id", body: str = "body") -> DataFrame:
    """One row per chunk with a body: id, model, dimension, vector, error.

    Rows are cleaned and their tokens counted before Python sees them. Texts go in requests of as many
    tokens as the model takes at once; vectors travel as arrays of floats. A request that fails is tried again
    after a pause; if it still fails, or gives another number of vectors than texts, it is asked text by text, so one bad
    text costs its own row only. A text beyond the model's limit is not sent. Chunks without a body get no row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            fits = [t is not None and n <= embedder.max_tokens for t, n in zip(texts, counts, strict=True)]
            for begin, end in requests([n if ok else 0 for n, ok in zip(counts, fits, strict=True)], embedder):
                asked = [at for at in range(begin, end) if fits[at]]
                vectors, errors = [None] * (end - begin), ["ErrContentEmpty" if texts[at] is None else "ErrTooManyTokens" for at in range(begin, end)]
                found = _answers(embedder, [texts[at] for at in asked]) if asked else ([], [])
                for at, vector, error in zip(asked, *found, strict=True):
                    vectors[at - begin], errors[at - begin] = vector, error
                columns = [batch.column(0).slice(begin, end - begin), _vector_column(vectors), pa.array(errors, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "vector", "error"])

    content = F.col(body)
    cleaned = F.when(text.is_embeddable(content), text.embedding_input(content))
    inputs = chunks.where(content.isNotNull()).select(F.col(key).cast("string").alias("id"), cleaned.alias("_input"))
    inputs = inputs.select("id", "_input", F.coalesce(token_count(F.col("_input")), F.lit(0)).alias("_tokens"))
    made = inputs.mapInArrow(run, "id string, vector array<float>, error string")
    size = F.size("vector")
    wrong = F.when(F.col("vector").isNotNull() & (size != embedder.dimension), "ErrUnsupportedEmbeddingDim")
    return made.select(
        "id",
        F.lit(embedder.model).alias("model"),
        F.lit(embedder.dimension).alias("dimension"),
        "vector",
        F.coalesce("error", wrong).alias("error"),
    )


def embedding_rows(embedded: DataFrame, stamp: Column, dims: dict[int, str] | None = None) -> DataFrame:
    """Stored form: the vector in the column of its dimension, keyed by chunk and model.

    The error says why a row has no vector.
    """
    vector = F.col("vector")
    return embedded.select(
        stable_id("id", "model").alias("id"),
        *[column.alias(name) for name, column in vectors.by_dimension(vector, dims).items()],
        "model",
        stamp.alias("embedded_at"),
        F.col("id").alias("object_id"),
        F.lit("chunk").alias("object_type"),
        F.coalesce(F.col("error"), vectors.dimension_error(vector, dims)).alias("error"),
    )


def request_payload(content: Column, model: Column) -> Column:
    """JSON request of a batch API; the encoding is named for the models that want it."""
    return F.to_json(
        F.struct(
            text.embedding_input(content).alias("input"),
            model.alias("model"),
            F.when(F.startswith(model, F.lit("text-embedding")), "float").alias("encoding_format"),
        )
    )


RESPONSE_SCHEMA = "struct<data:array<struct<embedding:array<float>,index:int>>,model:string>"


def parse_response(response: Column) -> Column:
    """(vector, error) of one response: the first embedding, or why there is none."""
    data = F.from_json(response, RESPONSE_SCHEMA)["data"]
    vector = F.get(data, F.lit(0))["embedding"]
    error = F.when(F.try_parse_json(response).isNull(), "ErrDecode").when(
        F.coalesce(F.size(data), F.lit(0)) <= 0, "ErrNoEmbeddingData"
    )
    return F.struct(vector.alias("vector"), error.alias("error"))


def token_limit_error(token_count: Column, max_tokens: Column) -> Column:
    return F.when(token_count > max_tokens, "ErrTooManyTokens")


def tokens_by_model(chunks: DataFrame, model: str = "model") -> DataFrame:
    """Token usage per model."""
    return chunks.groupBy(model).agg(F.count(F.lit(1)).alias("inputs"), F.sum("token_count").alias("tokens"))


ship_by_value(__name__)
