"""Live fetching through an injected function.

``fetch_fn(url)`` returns ``(status_code, headers, body)``; it runs in the tasks.
How many requests run at once is the number of partitions.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.options import ListingOptions
from corpusflow.workers import ship_by_value

# Bodies are large: hand them on in small frames.
_ROWS_AT_ONCE = 32
FetchFn = Callable[[str], tuple[int, dict, str]]
PAGE_SCHEMA = "base_url string, page int, status_code int, body string"
RESPONSE_SCHEMA = "url string, attempted_at timestamp, status_code int, headers map<string,array<string>>, body string"


#: Pages that fail in a row, each after all its retries, before a walk gives up. What it leaves is a page with this status.
FAILED_PAGES, CUT = 5, -1
#: Answers that may be others a little later: too early, too many requests, any failure of the server.
_FOR_NOW = frozenset((425, 429))


class Pace(NamedTuple):
    """The listing options as plain values, which tasks read without this package."""

    per_page: int
    max_pages: int | None
    concurrency: int
    retries: int
    pause: float


def pace(options: ListingOptions | None) -> Pace:
    opts = options or ListingOptions()
    return Pace(*(getattr(opts, name) for name in Pace._fields))


def fetch_listing(
    spark: SparkSession, base_url: str, fetch_fn: FetchFn, options: ListingOptions | None = None
) -> DataFrame:
    """Listing pages of one endpoint."""
    return fetch_pages(spark.createDataFrame([(base_url,)], "base_url string"), fetch_fn, options)


def fetch_pages(endpoints: DataFrame, fetch_fn: FetchFn, options: ListingOptions | None = None) -> DataFrame:
    """Listing pages of many endpoints (column base_url), each walked by several tasks in turn.

    Of n walks the first asks for pages 1, n + 1, ..., the second for 2, n + 2, ...; each
    goes on to its first page that answers 400 or lists nothing, so a listing of any
    length is read to its end; a page that is the one before again ends it too, since then
    the endpoint knows no pages. ``landing.listing_ids`` then applies the listing's end over all
    walks. A request that fails is tried again after a pause; if it still fails it is a page without a good
    status, and the walk goes on behind it. A walk that gives up says so by a page with status CUT.
    """
    opts = pace(options)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for base_url, first in zip(frame["base_url"], frame["first"]):
                for row in walk(fetch_fn, base_url, first, opts):
                    yield pd.DataFrame([row], columns=["base_url", "page", "status_code", "body"])

    starts = F.explode(F.sequence(F.lit(1), F.lit(opts.concurrency))).alias("first")
    firsts = endpoints.select("base_url").distinct().select("base_url", starts).repartition(opts.concurrency)
    return firsts.mapInPandas(run, PAGE_SCHEMA)


def walk(fetch_fn: FetchFn, base_url: str, first: int, opts: Pace) -> Iterator[tuple]:
    """(base_url, page, status_code, body) of every n-th page from the first, to the end of the listing."""
    page, failed, before = int(first), 0, None
    while failed < FAILED_PAGES:
        address = f"{base_url}?page={page}&per_page={opts.per_page}"
        _, status, _, body = _fetch_one(fetch_fn, address, opts.retries, opts.pause)
        yield base_url, page, status, body
        ended = status == 400 or (status == 200 and (body.strip() == "[]" or body == before))
        if ended or (opts.max_pages is not None and page > opts.max_pages):
            return
        failed, before = (0, body) if status == 200 else (failed + 1, before)
        page += opts.concurrency
    yield base_url, page, CUT, None


def _fetch_one(fetch_fn: FetchFn, address: str, retries: int = 0, pause: float = 0.0) -> tuple:
    """The answer to one request, or nulls where there is none; tried again while it may still come."""
    answer = (address, None, None, None)
    for turn in range(retries + 1):
        try:
            status, headers, body = fetch_fn(address)
            answer = (address, status, json.dumps(headers), body)
            if status is not None and status < 500 and status not in _FOR_NOW:
                break
        except Exception:
            answer = (address, None, None, None)
        if turn < retries:
            time.sleep(pause * 2**turn)
    return answer


def fetch_items(
    items: DataFrame, fetch_fn: FetchFn, concurrency: int, url: str = "item_url", retries: int = 0, pause: float = 0.0
) -> DataFrame:
    """One response per item URL; a request that fails after all its tries is a response without status."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for start in range(0, len(frame), _ROWS_AT_ONCE):
                rows = [_fetch_one(fetch_fn, address, retries, pause) for address in frame["url"].iloc[start : start + _ROWS_AT_ONCE]]
                yield pd.DataFrame(rows, columns=["url", "status_code", "headers", "body"])

    requests = items.select(F.col(url).alias("url")).distinct().repartition(concurrency)
    got = requests.mapInPandas(run, "url string, status_code int, headers string, body string")
    return got.select(
        "url",
        F.lit(None).cast("timestamp").alias("attempted_at"),
        "status_code",
        F.from_json("headers", "map<string,array<string>>").alias("headers"),
        "body",
    )


ship_by_value(__name__)
