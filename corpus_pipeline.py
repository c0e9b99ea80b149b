"""A corpus from raw documents to token ids: toxic documents, repeated lines, near copies and test items go.

Stages decide by row, not by doc_id: rows without an id and rows that share one are documents of their own.
Columns that have names the operators use go through under names of this module.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm import byte_bpe, decontamination, lines, near_duplicates, toxicity
from corpusflow.llm.training import held_out
from corpusflow.session import materialize

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Learned models cannot be expressed in SQL.
ORACLE_SQL = None


#: The key of a row within a stage.
KEY = "_key"


def _plain(docs: DataFrame) -> DataFrame:
    """docs with all columns but doc_id and text called by their place, so that none clashes with what an operator adds."""
    return docs.toDF(*[c if c in ("doc_id", "text") else f"_{i}" for i, c in enumerate(docs.columns)])


def _keyed(docs: DataFrame, purpose: str) -> DataFrame:
    """_plain with a key for each row, written once so that every reading has the same keys."""
    # The hash of one long is one to one, and has no pattern in its low bits.
    return materialize(_plain(docs).withColumn(KEY, F.xxhash64(F.monotonically_increasing_id())), purpose)


def _rows(keyed: DataFrame, keys: DataFrame, docs: DataFrame, how: str) -> DataFrame:
    """The rows with (left_semi) or without (left_anti) one of the keys; only the keys are hashed, the texts are not sorted."""
    some = keyed.join(keys.toDF("_some").hint("shuffle_hash"), F.col(KEY) == F.col("_some"), how)
    return some.drop(KEY).toDF(*docs.columns)


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labels that are not held out, does not call toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out(F.col("doc_id")))
    plain = _plain(docs)
    scored = toxicity.score(plain, toxicity.learn(plain, labels))
    return scored.where("predicted = 0").select(*plain.columns).toDF(*docs.columns)


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that three or more hold, but in the last of these; n_chars follows the text.

    Rows that share an id are one document here, so that copies of a row lose the same lines and
    meet as copies later. Rows without an id are told apart by their texts, and come before all others.
    """
    plain = _plain(docs)
    by_text = F.xxhash64(F.coalesce("text", F.lit(""))).bitwiseOR(F.lit(-(1 << 63)))
    kept = lines.dedup_lines(plain.withColumn(KEY, F.coalesce("doc_id", by_text)), KEY)
    own = [F.length("text").cast("long").alias(n) if c == "n_chars" else F.col(n) for c, n in zip(docs.columns, plain.columns, strict=True)]
    return kept.select(*own).toDF(*docs.columns)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, that of the smallest id or else one without, and all that have none."""
    keyed = _keyed(docs, "near_dedup_rows")
    groups = near_duplicates.near_duplicates(keyed, KEY, shingle=5, percent=80).select(KEY, "component_id")
    ids = groups.join(keyed.select(KEY, "doc_id"), KEY)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", KEY)).alias("first")
    return _rows(keyed, ids.groupBy("component_id").agg(first).select(f"first.{KEY}"), docs, "left_semi")


def remove_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    keyed = _keyed(docs, "decontamination_rows")
    found = decontamination.contained_items(keyed, items, KEY, shingle=5, percent=80)
    return _rows(keyed, found.select(KEY).distinct(), docs, "left_anti")


def encode_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids; text is what the ids decode to. Columns called n_tokens or ids are replaced."""
    where = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    plain = _plain(docs)
    decoded = byte_bpe.encode(plain, "text", "ids", *where, decoded="raw")
    text = F.decode("raw", "UTF-8")
    kept = [(n, c) for n, c in zip(plain.columns, docs.columns, strict=True) if c.lower() not in ("n_tokens", "ids")]
    names = [(text if n == "text" else F.col(n)).alias(c) for n, c in kept]
    return decoded.select(*names, F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", remove_toxic),
    ("line_dedup", remove_repeated_lines),
    ("near_dedup", remove_near_copies),
    ("decontamination", remove_test_items),
    ("byte_bpe", encode_bytes),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each but the last written to the shared folder before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
