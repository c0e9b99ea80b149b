"""Landed post responses: listing pages and items."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.functions import urls
from corpusflow.functions.ids import stable_id
from corpusflow.operators import posts
from corpusflow.operators.barrier import computed_once
from corpusflow.operators.upsert import newest_rows
from corpusflow.session import materialize
from corpusflow.sources import fetch


class Imported(NamedTuple):
    sources: DataFrame
    downloads: DataFrame
    rejects: DataFrame


class Listing(NamedTuple):
    items: DataFrame
    rejects: DataFrame


def _elements(body: Column) -> Column:
    return F.try_variant_get(F.try_parse_json(body), "$", "array<variant>")


def listing_ids(pages: DataFrame, max_pages: int | None = None) -> Listing:
    """Item ids of all listing pages before each site's end.

    The end is the first page that answers 400 or lists nothing. A page with another
    status, or without a JSON array, is a reject and the pages after it still count; so is
    the place where a live walk gave up.
    With ``max_pages`` every live page beyond it is a reject as well.
    """
    status = F.col("status_code")
    beyond = F.lit(False) if max_pages is None else F.col("page") > max_pages

    def item_id(element: Column) -> Column:
        return posts.whole_number_at(element, "$.id")

    # The bodies are parsed once; what follows reads page numbers and ids only.
    parsed = computed_once(pages, {"_elements": _elements(F.col("body"))})
    read = materialize(
        parsed.select(
            "base_url", "page", "status_code", F.size("_elements").alias("listed"),
            F.filter(F.transform("_elements", item_id), lambda value: value.isNotNull()).alias("ids"),
        ),
        "listing",
    )
    empty = (status == 200) & (F.col("listed") == 0)
    ends = read.groupBy("base_url").agg(F.min(F.when((status == 400) | empty, F.col("page"))).alias("_end"))
    live = read.join(ends, "base_url").where(F.col("_end").isNull() | (F.col("page") < F.col("_end")))
    error = (
        F.when(beyond | (status == fetch.CUT), "ErrListingCut")
        .when(status.isNull(), "ErrNoResponse")
        .when(status != 200, "ErrUnexpectedStatusCode")
        .when(F.col("ids").isNull(), "ErrDecode")
    )
    live = live.withColumn("error", error)
    items = (
        live.where(F.col("error").isNull())
        .select("base_url", "page", F.posexplode("ids").alias("pos", "item_id"))
        .withColumn("item_url", F.concat_ws("/", "base_url", F.col("item_id").cast("string")))
    )
    rejects = live.where(F.col("error").isNotNull()).select("base_url", "page", "status_code", "error")
    return Listing(items, rejects)


def source_rows(df: DataFrame, url: str, file_format: Column, stamp: Column) -> DataFrame:
    """Source table rows of item URLs; the URL is the natural key."""
    u = F.col(url)
    return df.select(
        stable_id(u).alias("id"),
        F.lit(None).cast("string").alias("author_email"),
        u.alias("raw_url"),
        urls.scheme(u).alias("scheme"),
        urls.host(u).alias("host"),
        urls.path(u).alias("path"),
        urls.query(u).alias("query"),
        F.lit(1).alias("active_domain"),
        file_format.alias("format"),
        stamp.alias("created_at"),
        stamp.alias("updated_at"),
    )


def download_rows(df: DataFrame, url: str, headers: Column, stamp: Column) -> DataFrame:
    """Download table rows; the id follows from source and body, so a second delivery is no new row."""
    body = F.col("body")
    return df.select(
        stable_id(stable_id(F.col(url)), F.sha2(body, 256)).alias("id"),
        stable_id(F.col(url)).alias("source_id"),
        F.coalesce("attempted_at", stamp).alias("attempted_at"),
        F.coalesce("attempted_at", stamp).alias("downloaded_at"),
        "status_code",
        headers.alias("headers"),
        "body",
    )


def fetched_items(items: DataFrame, responses: DataFrame, json_type_only: bool = False) -> DataFrame:
    """Listed items with their newest response and the reason a response is not usable.

    ``json_type_only`` also refuses a body that is not declared as JSON.
    """
    status = F.col("status_code")
    # Judged before any shuffle, so that bodies travel only where they are asked for.
    refusal = (
        F.when(status.isNull(), "ErrNoResponse")
        .when(status != 200, "ErrUnexpectedPostStatusCode")
        .when(F.lit(json_type_only) & ~_declared_json(F.col("headers")), "ErrContentType")
        .when(posts.parsed(F.col("body")).isNull(), "ErrDecode")
    )
    newest = newest_rows(responses, ["url"], F.col("attempted_at"), F.xxhash64("status_code", "body"))
    newest = newest.withColumn("error", refusal)
    # Items are the hashed side; bodies are not sorted.
    met = items.hint("shuffle_hash").join(newest, items["item_url"] == newest["url"], "left")
    return met.withColumn("error", F.when(F.col("url").isNull(), "ErrNoResponse").otherwise(F.col("error"))).drop("url")


def _declared_json(headers: Column) -> Column:
    """Whether any content type names JSON; header names in any case."""
    types = F.map_filter(headers, lambda name, _: F.lower(name) == "content-type")
    named = F.exists(F.flatten(F.map_values(types)), lambda value: F.contains(F.lower(value), F.lit("json")))
    return F.coalesce(named, F.lit(False))


def import_items(
    items: DataFrame, responses: DataFrame, stamp: Column, json_type_only: bool = False
) -> Imported:
    """Source and download rows of all good responses; everything else is a reject.

    Each item counts once even if several pages list it.
    """
    fetched = materialize(fetched_items(items.dropDuplicates(["item_url"]), responses, json_type_only), "fetched")
    good = fetched.where(F.col("error").isNull())
    return Imported(
        source_rows(good, "item_url", F.lit("json"), stamp),
        download_rows(good, "item_url", F.to_json("headers"), stamp),
        fetched.where(F.col("error").isNotNull()).select("base_url", "item_url", "status_code", "error"),
    )


def import_responses(responses: DataFrame, stamp: Column) -> Imported:
    """Source and download rows of responses of a kind of one's own; the address is the source."""
    newest = newest_rows(responses, ["url"], F.col("attempted_at"), F.xxhash64("status_code", "body"))
    status = F.col("status_code")
    error = F.when(status.isNull() | F.col("body").isNull(), "ErrNoResponse").when(status != 200, "ErrUnexpectedStatusCode")
    judged = materialize(newest.withColumn("error", error), "responses")
    good = judged.where(F.col("error").isNull())
    return Imported(
        source_rows(good, "url", F.lit("json"), stamp),
        download_rows(good, "url", F.to_json("headers"), stamp),
        judged.where(F.col("error").isNotNull()).select("url", "status_code", "error"),
    )
