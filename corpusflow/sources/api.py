"""Listings and items of an API as data sources of Spark, in batch and as a stream.

``listing_source(fetch_fn)`` and ``item_source(fetch_fn)`` make the classes to register::

    spark.dataSource.register(listing_source(fetch_fn))
    spark.read.format("api_listing").option("endpoints", "https://a.org/posts,https://b.org/posts").load()
    spark.readStream.format("api_listing").option("endpoints", "https://a.org/posts").load()

Requests run in the tasks. A batch read is parted by walk, as ``fetch.fetch_pages`` does it; equality filters on base_url
or url are taken over, so endpoints and items that are not asked for are not requested. The session needs
``spark.sql.python.filterPushdown.enabled``, which ``build_session`` sets.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, In, InputPartition

from corpusflow.options import ListingOptions
from corpusflow.sources.fetch import PAGE_SCHEMA, FetchFn, Pace, _fetch_one, pace, walk
from corpusflow.workers import ship_by_value

ship_by_value(__name__)

ITEM_SCHEMA = "url string, status_code int, headers string, body string"


def _names(options: dict, name: str) -> list[str]:
    """A list in an option: comma-separated, or a JSON array."""
    text = options.get(name, "").strip()
    found = json.loads(text) if text.startswith("[") else text.split(",")
    names = list(dict.fromkeys(n.strip() for n in found if n.strip()))
    if not names:
        raise ValueError(f"ErrNoEndpoint: option {name} is empty")
    return names


def _taken(filters, column: str, names: list[str]) -> tuple[list[str], list]:
    """(names that the filters leave, filters that are not taken over)."""
    rest = []
    for f in filters:
        if isinstance(f, EqualTo) and f.attribute == (column,):
            names = [n for n in names if n == f.value]
        elif isinstance(f, In) and f.attribute == (column,):
            names = [n for n in names if n in f.value]
        else:
            rest.append(f)
    return names, rest


@dataclass
class Walk(InputPartition):
    base_url: str
    first: int


@dataclass
class Pages(InputPartition):
    base_url: str
    page: int
    skip: int
    until: int


@dataclass
class Items(InputPartition):
    urls: list[str]


class _ListingReader(DataSourceReader):
    def __init__(self, fetch_fn: FetchFn, endpoints: list[str], options: Pace):
        self.fetch_fn, self.endpoints, self.options = fetch_fn, endpoints, options

    def pushFilters(self, filters):
        self.endpoints, rest = _taken(filters, "base_url", self.endpoints)
        yield from rest

    def partitions(self) -> list[InputPartition]:
        # Spark asks for one partition at least; an empty walk has no endpoint.
        walks = [Walk(base, first) for base in self.endpoints for first in range(1, self.options.concurrency + 1)]
        return walks or [Walk("", 0)]

    def read(self, partition: Walk) -> Iterator[tuple]:
        if partition.base_url:
            yield from walk(self.fetch_fn, partition.base_url, partition.first, self.options)


class _ListingStream(DataSourceStreamReader):
    """Offsets count the items of each endpoint, which must only grow at its end (oldest first).

    A micro-batch has the pages that hold items it does not know; a last page that was not full comes again when
    it has more. The end is found by asking for pages further and further on and halving what is left, so an offset
    costs few requests however long the listing is.
    """

    def __init__(self, fetch_fn: FetchFn, endpoints: list[str], options: Pace):
        self.fetch_fn, self.endpoints, self.options = fetch_fn, endpoints, options
        self.known: dict[str, int] = {}

    def _listed(self, base: str, page: int) -> int:
        """Items of a page; none where there is no such page. A request that fails ends the batch, to be tried by the next one."""
        address = f"{base}?page={page}&per_page={self.options.per_page}"
        _, status, _, body = _fetch_one(self.fetch_fn, address, self.options.retries, self.options.pause)
        if status == 400:
            return 0
        if status != 200:
            raise RuntimeError(f"ErrNoResponse: {address}")
        found = json.loads(body)
        return len(found) if isinstance(found, list) else 0

    def _items(self, base: str) -> int:
        low, step = self.known.get(base, 0) // self.options.per_page, 1
        while self._listed(base, low + step) == self.options.per_page:
            low, step = low + step, 2 * step
        high = low + step
        while high - low > 1:
            middle = (low + high) // 2
            if self._listed(base, middle) == self.options.per_page:
                low = middle
            else:
                high = middle
        return low * self.options.per_page + self._listed(base, low + 1)

    def initialOffset(self) -> dict:
        return dict.fromkeys(self.endpoints, 0)

    def latestOffset(self) -> dict:
        self.known = {base: self._items(base) for base in self.endpoints}
        return self.known

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        size, out = self.options.per_page, []
        for base, until in end.items():
            begin = start.get(base, 0)
            if until > begin:
                out += [Pages(base, page, begin, until) for page in range(begin // size + 1, -(-until // size) + 1)]
        return out or [Pages("", 0, 0, 0)]

    def read(self, partition: Pages) -> Iterator[tuple]:
        if partition.base_url:
            address = f"{partition.base_url}?page={partition.page}&per_page={self.options.per_page}"
            _, status, _, body = _fetch_one(self.fetch_fn, address, self.options.retries, self.options.pause)
            yield partition.base_url, partition.page, status, body

    def commit(self, end: dict) -> None:
        pass


class _ItemReader(DataSourceReader):
    def __init__(self, fetch_fn: FetchFn, urls: list[str], options: Pace):
        self.fetch_fn, self.urls, self.options = fetch_fn, urls, options

    def pushFilters(self, filters):
        self.urls, rest = _taken(filters, "url", self.urls)
        yield from rest

    def partitions(self) -> list[InputPartition]:
        n = self.options.concurrency
        return [Items(self.urls[i::n]) for i in range(min(n, len(self.urls)))] or [Items([])]

    def read(self, partition: Items) -> Iterator[tuple]:
        for url in partition.urls:
            yield _fetch_one(self.fetch_fn, url, self.options.retries, self.options.pause)


def _options(given: ListingOptions | None, options: dict) -> Pace:
    """The options of the class, overridden by those of the read."""
    named = {name: int(options[name]) for name in ("per_page", "max_pages", "concurrency", "retries") if name in options}
    return pace(given)._replace(**named)


def listing_source(fetch_fn: FetchFn, options: ListingOptions | None = None, name: str = "api_listing") -> type[DataSource]:
    """A source of the listing pages of the endpoints in option ``endpoints``; ``host`` keeps those of one host."""

    class Listing(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return PAGE_SCHEMA

        def _endpoints(self) -> list[str]:
            found, host = _names(self.options, "endpoints"), self.options.get("host")
            return [n for n in found if host is None or urlsplit(n).hostname == host]

        def reader(self, schema) -> DataSourceReader:
            return _ListingReader(fetch_fn, self._endpoints(), _options(options, self.options))

        def streamReader(self, schema) -> DataSourceStreamReader:
            return _ListingStream(fetch_fn, self._endpoints(), _options(options, self.options))

    return Listing


def item_source(fetch_fn: FetchFn, options: ListingOptions | None = None, name: str = "api_items") -> type[DataSource]:
    """A source of the responses to the addresses in option ``urls``; larger sets go through ``fetch.fetch_items``."""

    class Item(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return ITEM_SCHEMA

        def reader(self, schema) -> DataSourceReader:
            return _ItemReader(fetch_fn, _names(self.options, "urls"), _options(options, self.options))

    return Item
