"""From source URLs to landed responses, through an injected fetch function."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.functions import urls
from corpusflow.options import FileOptions, ListingOptions
from corpusflow.plans import parts
from corpusflow.plans.ingest import Landed
from corpusflow.session import materialize
from corpusflow.sources import landing, repository
from corpusflow.sources.fetch import FetchFn, fetch_items, fetch_pages


class Fetched(NamedTuple):
    landed: Landed
    rejects: DataFrame


def land(
    sources: DataFrame,
    fetch_fn: FetchFn,
    listing_options: ListingOptions | None = None,
    file_options: FileOptions | None = None,
    api_url: str = "https://api.github.com",
    importers: list[parts.Importer] | None = None,
) -> Fetched:
    """Fetch everything the source URLs (column raw_url) lead to.

    A user's ``importers`` come before the two for posts and repositories: what they accept is asked for as it is.

    Answers are written as they come, since asking again costs and may differ. Files
    are filtered by their tree entries before their contents are asked for.
    """
    opts = listing_options or ListingOptions()
    addresses, others = sources.select("raw_url").distinct(), None
    if importers:
        own = parts.source_type(F.col("raw_url"), importers).isNotNull()
        asked = addresses.where(own).select(F.col("raw_url").alias("url"))
        others = materialize(fetch_items(asked, fetch_fn, opts.concurrency, "url", opts.retries, opts.pause), "others")
        addresses = addresses.where(~own)
    routed = urls.route_import(addresses)
    unrouted = routed.where(F.col("error").isNotNull()).select("raw_url", "error")

    endpoints = routed.where(F.col("source_type") == "wp-json").select(F.col("raw_url").alias("base_url"))
    pages = materialize(fetch_pages(endpoints, fetch_fn, opts), "pages")
    listed = landing.listing_ids(pages, opts.max_pages).items
    items = materialize(fetch_items(listed, fetch_fn, opts.concurrency, retries=opts.retries, pause=opts.pause), "items")

    repos = routed.where(F.col("source_type") == "github").select("raw_url", "owner", "repo", "ref")
    tree_url = F.concat(
        F.lit(f"{api_url}/repos/"), F.concat_ws("/", "owner", "repo", F.lit("git/trees"), "ref"), F.lit("?recursive=1")
    )
    asked = repos.withColumn("url", tree_url)
    answers = materialize(fetch_items(asked, fetch_fn, opts.concurrency, "url", opts.retries, opts.pause), "trees")
    answered = asked.join(answers, "url")
    good = (F.col("status_code") == 200) & F.try_parse_json("body").isNotNull()
    trees = repository.tree_items(answered.where(good), keep=("owner", "repo", "ref")).distinct()
    failed = answered.where(~F.coalesce(good, F.lit(False))).select(
        "raw_url", F.lit("ErrGitHubAPIRequestFailed").alias("error")
    )
    # A tree that the service cut off is used as far as it goes, and said to be cut.
    truncated = F.try_variant_get(F.try_parse_json("body"), "$.truncated", "boolean")
    failed = failed.unionByName(
        answered.where(good & truncated).select("raw_url", F.lit("ErrTreeTruncated").alias("error"))
    )

    content_url = F.concat(
        F.lit(f"{api_url}/repos/"), F.concat_ws("/", "owner", "repo", F.lit("contents"), "path"), F.lit("?ref="), F.col("ref")
    )
    wanted = repository.filter_files(trees, file_options).select("owner", "repo", "ref", "path").withColumn("url", content_url)
    bodies = materialize(fetch_items(wanted, fetch_fn, opts.concurrency, "url", opts.retries, opts.pause), "contents")
    read = F.from_json("body", repository.CONTENTS_SCHEMA)
    contents = wanted.join(bodies, "url").select(
        "owner", "repo", "ref", "path", "status_code", "attempted_at",
        read["content"].alias("content"), read["encoding"].alias("encoding"),
    )
    return Fetched(Landed(pages, items, trees, contents, others), unrouted.unionByName(failed))
