"""Live reading: retries, walks that give up, and the API as a data source in batch and as a stream."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from corpusflow.options import ListingOptions
from corpusflow.session import work_dir
from corpusflow.sources import api, fetch, landing
from corpusflow.workers import ship_by_value

ship_by_value(__name__)


def page_of(url):
    return int(url.split("page=")[1].split("&")[0])


def listing(size):
    """A listing of so many items, as many to a page as asked for."""

    def answer(url):
        page, per_page = page_of(url), int(url.rsplit("=", 1)[1])
        ids = list(range((page - 1) * per_page + 1, min(page * per_page, size) + 1))
        return (200, {}, json.dumps([{"id": i} for i in ids])) if ids else (400, {}, "{}")

    return answer


def ids(pages, **options):
    return sorted(r.item_id for r in landing.listing_ids(pages, **options).items.collect())


def test_an_outage_is_sat_out(spark, tmp_path):
    """Twenty failed requests in a row, over all walks: nothing is lost."""
    counter = str(tmp_path / "requests")

    def answer(url):
        with open(counter, "a") as out:
            out.write("x")
        if 10 < Path(counter).stat().st_size <= 30:
            raise ConnectionError("down")
        return listing(60)(url)

    options = ListingOptions(per_page=2, concurrency=2, retries=21, pause=0)
    got = landing.listing_ids(fetch.fetch_listing(spark, "https://a.org/p", answer, options))
    assert sorted(r.item_id for r in got.items.collect()) == list(range(1, 61)) and got.rejects.count() == 0


def test_a_walk_that_gives_up_is_a_reject(spark):
    def answer(url):
        if page_of(url) % 3 == 2 and page_of(url) > 4:
            return 503, {}, ""
        return listing(60)(url)

    options = ListingOptions(per_page=1, concurrency=3, retries=1, pause=0)
    got = landing.listing_ids(fetch.fetch_listing(spark, "https://a.org/p", answer, options))
    lost = [p for p in range(5, 61) if p % 3 == 2]
    assert sorted(r.item_id for r in got.items.collect()) == sorted(set(range(1, 61)) - set(lost))
    rejects = {r.page: r.error for r in got.rejects.collect()}
    assert rejects == {**dict.fromkeys(lost[: fetch.FAILED_PAGES], "ErrUnexpectedStatusCode"), lost[fetch.FAILED_PAGES]: "ErrListingCut"}


@pytest.mark.parametrize("status, tries", [(404, 1), (400, 1), (429, 4), (500, 4), (None, 4)])
def test_what_is_tried_again(status, tries):
    asked = []

    def answer(url):
        asked.append(url)
        if status is None:
            raise OSError("gone")
        return status, {}, ""

    got = fetch._fetch_one(answer, "u", retries=3)
    assert len(asked) == tries and got[1] == status


OPTIONS = ListingOptions(per_page=3, concurrency=2, pause=0)


def sized(url):
    return listing(10 if "a.org" in url else 4)(url)


def test_batch_source(spark):
    spark.dataSource.register(api.listing_source(sized, OPTIONS, "test_listing"))
    ends = "https://a.org/p, https://b.org/p"
    pages = spark.read.format("test_listing").option("endpoints", ends).load()
    assert pages.rdd.getNumPartitions() == 4
    walked = fetch.fetch_pages(spark.createDataFrame([(e.strip(),) for e in ends.split(",")], "base_url string"), sized, OPTIONS)
    assert sorted(map(str, pages.collect())) == sorted(map(str, walked.collect()))
    assert ids(pages) == sorted([*range(1, 11), *range(1, 5)])
    one = spark.read.format("test_listing").option("endpoints", json.dumps(ends.split(","))).option("host", "b.org").load()
    assert ids(one) == [1, 2, 3, 4]
    with pytest.raises(Exception, match="ErrNoEndpoint"):
        spark.read.format("test_listing").load().count()


def test_filters_are_taken_over(spark, tmp_path):
    asked = tmp_path / "asked"
    asked.mkdir()
    folder = str(asked)

    def answer(url):
        Path(folder, url.split("/")[2]).touch()
        return sized(url)

    spark.dataSource.register(api.listing_source(answer, OPTIONS, "test_filtered"))
    pages = spark.read.format("test_filtered").option("endpoints", "https://a.org/p,https://b.org/p").load()
    assert ids(pages.where(F.col("base_url") == "https://b.org/p")) == [1, 2, 3, 4]
    assert [p.name for p in asked.iterdir()] == ["b.org"]
    assert pages.where(F.col("base_url").isin("https://c.org/p", "https://d.org/p")).count() == 0


def test_item_source(spark):
    spark.dataSource.register(api.item_source(lambda url: (200, {"Content-Type": ["x"]}, url[-1]), OPTIONS, "test_items"))
    got = spark.read.format("test_items").option("urls", "https://a.org/1,https://a.org/2,https://a.org/1").load()
    assert sorted((r.url, r.status_code, r.headers, r.body) for r in got.collect()) == [
        ("https://a.org/1", 200, '{"Content-Type": ["x"]}', "1"), ("https://a.org/2", 200, '{"Content-Type": ["x"]}', "2"),
    ]


def test_stream_source(spark, tmp_path):
    """A listing that grows: each batch has the pages with items it has not seen; a restart goes on where it was."""
    sizes = str(tmp_path / "size")

    def answer(url):
        return listing(int(Path(sizes).read_text()) if "a.org" in url else 4)(url)

    spark.dataSource.register(api.listing_source(answer, OPTIONS, "test_stream"))
    root = work_dir(spark, "api-stream")

    def run(*steps):
        stream = spark.readStream.format("test_stream").option("endpoints", "https://a.org/p,https://b.org/p").load()
        query = stream.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/cp").start()
        try:
            for size in steps:
                Path(sizes).write_text(str(size))
                query.processAllAvailable()
        finally:
            query.stop()
        rows = spark.read.parquet(f"{root}/out").collect()
        return sorted((r.base_url[8], r.page, len(json.loads(r.body))) for r in rows)

    Path(sizes).write_text("7")
    first = run(7)
    assert first == [("a", 1, 3), ("a", 2, 3), ("a", 3, 1), ("b", 1, 3), ("b", 2, 1)]
    grown = run(7, 8, 40)
    fresh = [x for x in grown if x not in first]
    # The last page came again when it had more.
    assert set(fresh) == {("a", 3, 2), ("a", 3, 3), *[("a", p, 3) for p in range(4, 14)], ("a", 14, 1)}
    assert len(grown) == len(first) + len(fresh)
