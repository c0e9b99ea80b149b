"""Repository trees and file contents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow import fixed
from corpusflow.functions import paths, text
from corpusflow.operators.upsert import newest_per_key, newest_rows
from corpusflow.options import FileOptions
from corpusflow.session import materialize
from corpusflow.sources.landing import Imported, download_rows, source_rows

TREE_SCHEMA = "tree array<struct<path:string,mode:string,type:string,sha:string,size:bigint,url:string>>"
CONTENTS_SCHEMA = (
    "name string, path string, sha string, size bigint, url string, html_url string, git_url string, "
    "download_url string, type string, content string, encoding string"
)


def tree_items(responses: DataFrame, body: str = "body", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per entry of landed tree responses."""
    return responses.select(*keep, F.inline(F.from_json(F.col(body), TREE_SCHEMA)["tree"]))


def read_tree(spark: SparkSession, location: str) -> DataFrame:
    return spark.read.schema(TREE_SCHEMA).json(location, multiLine=True).select(F.inline("tree"))


def read_contents(spark: SparkSession, location: str) -> DataFrame:
    """Landed file-content responses; content and encoding stay as delivered."""
    return spark.read.schema(CONTENTS_SCHEMA).json(location, multiLine=True)


def read_checkout(spark: SparkSession, root: str) -> DataFrame:
    """Files of a checked-out repository in the shape of tree entries plus content and error.

    A file that is not UTF-8 has no content and says so; it does not stop the others.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    header = F.concat(F.lit("blob "), F.col("length").cast("string")).cast("binary")
    blob = F.concat(header, F.unhex(F.lit("00")), F.col("content"))
    text_like = F.is_valid_utf8(F.col("content").cast("string"))
    return files.select(
        F.regexp_replace(F.substring_index("path", root.rstrip("/") + "/", -1), "^/+", "").alias("path"),
        F.lit("blob").alias("type"),
        F.sha1(blob).alias("sha"),
        F.col("length").alias("size"),
        F.when(text_like, F.col("content").cast("string")).alias("content"),
        F.lit("utf-8").alias("encoding"),
        F.when(~text_like, "ErrEncoding").alias("error"),
    )


def is_wanted(options: FileOptions | None = None) -> Column:
    """Blob, not excluded, with an importable extension, whatever its size."""
    opts = options or FileOptions()
    path = F.col("path")
    return (
        (F.col("type") == "blob")
        & ~paths.is_excluded(path, opts.exclusions, opts.match)
        & paths.is_importable(path, opts.extensions)
    )


def is_too_large(options: FileOptions | None = None) -> Column:
    """Larger than the bound; never where there is none or the size is not known."""
    opts = options or FileOptions()
    return F.lit(False) if opts.max_size is None else F.coalesce(F.col("size") > opts.max_size, F.lit(False))


def filter_files(items: DataFrame, options: FileOptions | None = None) -> DataFrame:
    return items.where(is_wanted(options) & ~is_too_large(options))


def file_url() -> Column:
    return F.concat(
        F.lit("https://github.com/"), F.concat_ws("/", "owner", "repo", F.lit("blob"), "ref", "path")
    )


def file_headers(sha: Column) -> Column:
    return F.to_json(
        F.struct(
            F.array(F.lit("text/plain")).alias("Content-Type"), F.array(sha).alias(fixed.SHA_HEADER)
        )
    )


def fetched_files(items: DataFrame, contents: DataFrame, options: FileOptions | None = None) -> DataFrame:
    """Wanted tree entries with their newest content response and the reason it is not usable.

    Filtering comes first: content is joined only for files that are kept. An entry
    listed twice counts once, and of several answers for a file the newest counts.
    """
    key = ["owner", "repo", "ref", "path"]
    entry = newest_per_key(items.where(is_wanted(options)), key, [F.col("size").desc_nulls_last(), F.col("sha")])
    wanted = entry.withColumns({"file_url": file_url(), "_large": is_too_large(options)})
    answers = newest_rows(contents, key, F.col("attempted_at"), F.xxhash64("status_code", "content", "encoding"))
    bodies = answers.select(*key, "status_code", "attempted_at", F.col("content").alias("body"), "encoding")
    error = (
        F.when(F.col("_large"), "ErrFileTooLarge")
        .when(F.col("status_code").isNull(), "ErrNoResponse")
        .when(F.col("status_code") != 200, "ErrGitHubAPIRequestFailed")
    )
    return wanted.hint("shuffle_hash").join(bodies, key, "left").withColumn("error", error).drop("_large")


def import_files(
    items: DataFrame, contents: DataFrame, stamp: Column, options: FileOptions | None = None
) -> Imported:
    """Source and download rows of all wanted files; downloads carry their encoding."""
    fetched = materialize(fetched_files(items, contents, options), "fetched")
    good = fetched.where(F.col("error").isNull())
    kind = paths.stored_format(paths.extension(F.col("path")))
    decoded = good.withColumn(
        "body",
        F.when(
            F.col("encoding") == "base64",
            F.coalesce(text.decoded_base64(F.col("body")), F.col("body")),
        ).otherwise(F.col("body")),
    )
    return Imported(
        source_rows(good, "file_url", kind, stamp),
        download_rows(decoded, "file_url", file_headers(F.col("sha")), stamp),
        fetched.where(F.col("error").isNotNull()).select("owner", "repo", "path", "status_code", "error"),
    )
