import json

from pyspark.sql import functions as F

from corpusflow.options import FileOptions, ListingOptions
from corpusflow.plans import ingest, live
from corpusflow.sources import fetch, landing, repository
from corpusflow.workers import ship_by_value

ship_by_value(__name__)


def stamp():
    return F.lit("2024-01-01 00:00:00").cast("timestamp")


def pages(spark, rows):
    return spark.createDataFrame(rows, "base_url string, page int, status_code int, body string")


def ids(*numbers):
    return json.dumps([{"id": n} for n in numbers])


def test_listing_ends_at_400(spark):
    listing = landing.listing_ids(
        pages(spark, [("u", 1, 200, ids(1, 2, 3)), ("u", 2, 200, ids(4)), ("u", 3, 400, "{}"), ("u", 4, 200, ids(9))])
    )
    assert [r.item_id for r in listing.items.orderBy("page", "pos").collect()] == [1, 2, 3, 4]
    assert listing.items.orderBy("page", "pos").first().item_url == "u/1"
    assert listing.rejects.count() == 0


def test_listing_ends_at_empty_page_and_reports_bad_pages(spark):
    listing = landing.listing_ids(
        pages(
            spark,
            [
                ("u", 1, 200, ids("x", 7, 7)), ("u", 2, 500, ""), ("u", 3, 200, "<html>"), ("u", 4, 200, ids(8)),
                ("u", 5, 200, "[]"), ("u", 6, 200, ids(9)), ("v", 1, 200, ids(1)),
            ],
        )
    )
    assert sorted((r.base_url, r.item_id) for r in listing.items.collect()) == [("u", 7), ("u", 7), ("u", 8), ("v", 1)]
    assert sorted((r.page, r.error) for r in listing.rejects.collect()) == [(2, "ErrUnexpectedStatusCode"), (3, "ErrDecode")]


def test_page_cap(spark):
    rows = pages(spark, [("u", n, 200, ids(n)) for n in range(1, 6)])
    cut = landing.listing_ids(rows, max_pages=2)
    assert cut.items.count() == 2 and {r.error for r in cut.rejects.collect()} >= {"ErrListingCut"}
    assert landing.listing_ids(rows, max_pages=None).items.count() == 5


def responses(spark, rows):
    ddl = "url string, attempted_at timestamp, status_code int, headers map<string,array<string>>, body string"
    return spark.createDataFrame(rows, ddl)


def test_import_items(spark):
    items = spark.createDataFrame([("u", n, f"u/{n}") for n in (1, 2, 3, 4, 4)], "base_url string, item_id int, item_url string")
    json_type = {"content-type": ["application/json; charset=UTF-8"]}
    got = landing.import_items(
        items,
        responses(
            spark,
            [
                ("u/1", None, 200, json_type, '{"a":1}'), ("u/2", None, 404, json_type, "{}"),
                ("u/3", None, 200, {}, "<html>"), ("u/4", None, 200, {"Content-Type": ["text/html"]}, '{"b":1}'),
                ("u/4", None, 200, {"Content-Type": ["text/html"]}, '{"b":1}'),
            ],
        ),
        stamp(),
    )
    assert sorted(r.raw_url for r in got.sources.collect()) == ["u/1", "u/4"]
    assert sorted(r.body for r in got.downloads.collect()) == ['{"a":1}', '{"b":1}']
    assert sorted((r.item_url, r.error) for r in got.rejects.collect()) == [
        ("u/2", "ErrUnexpectedPostStatusCode"), ("u/3", "ErrDecode"),
    ]


def test_json_type_only(spark):
    items = spark.createDataFrame([("u", n, f"u/{n}") for n in (1, 2)], "base_url string, item_id int, item_url string")
    good = responses(
        spark, [("u/1", None, 200, {"CONTENT-TYPE": ["application/json"]}, "{}"), ("u/2", None, 200, {"x": ["json"]}, "{}")]
    )
    got = landing.fetched_items(items, good, json_type_only=True)
    assert {r.item_url: r.error for r in got.collect()} == {"u/1": None, "u/2": "ErrContentType"}


def test_newest_response_counts(spark):
    items = spark.createDataFrame([("u", 1, "u/1")], "base_url string, item_id int, item_url string")
    both = spark.sql(
        "select 'u/1' as url, timestamp '2024-01-02' as attempted_at, 200 as status_code, "
        "map('a', array('b')) as headers, '{\"n\":2}' as body union all "
        "select 'u/1', timestamp '2024-01-01', 500, map('a', array('b')), ''"
    )
    assert landing.import_items(items, both, stamp()).downloads.first().body == '{"n":2}'


def entry(path, size, kind="blob"):
    return {"path": path, "type": kind, "size": size, "sha": f"sha-{path}"}


TREE = {
    "tree": [
        entry("notes/plan.rst", 40), entry("tool.py", 900), entry("Setup.CFG", 12), entry("notes", 0, "tree"),
        entry("dist/tool.py", 5), entry(".vscode/settings.json", 5), entry("dump.txt", 3 << 20), entry("logo.svgz", 7),
    ]
}
WANTED = ["notes/plan.rst", "tool.py", "Setup.CFG"]


def test_tree_filter(spark, tmp_path):
    (tmp_path / "tree.json").write_text(json.dumps(TREE, indent=1))
    items = repository.read_tree(spark, str(tmp_path))
    assert items.count() == 8
    assert [r.path for r in repository.filter_files(items).collect()] == [*WANTED, "dump.txt"]
    assert [r.path for r in repository.filter_files(items, FileOptions(max_size=1 << 20)).collect()] == WANTED
    unknown = items.withColumn("size", F.lit(None).cast("bigint"))
    assert repository.filter_files(unknown, FileOptions(max_size=1)).count() == 4
    other = FileOptions(exclusions=[], extensions=[".SVGZ"], max_size=10)
    assert [r.path for r in repository.filter_files(items, other).collect()] == ["logo.svgz"]
    as_text = spark.createDataFrame([(json.dumps(TREE),)], "body string")
    assert repository.tree_items(as_text).count() == 8


def test_files_that_are_not_text(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("caf\u00e9".encode("latin-1"))
    (tmp_path / "b.png").write_bytes(b"\x89PNG\xff\x00")
    (tmp_path / "c.txt").write_text("caf\u00e9", encoding="utf-8")
    got = {r.path: (r.content, r.error) for r in repository.read_checkout(spark, str(tmp_path)).collect()}
    assert got == {"a.txt": (None, "ErrEncoding"), "b.png": (None, "ErrEncoding"), "c.txt": ("caf\u00e9", None)}


def test_one_answer_per_file(spark):
    items = spark.createDataFrame(
        [("o", "r", "main", p, "blob", "s", n) for p, n in (("a.md", 1), ("a.md", 1), ("b.md", 50), ("c.md", None))],
        "owner string, repo string, ref string, path string, type string, sha string, size bigint",
    )
    contents = spark.sql(
        "select 'o' as owner, 'r' as repo, 'main' as ref, path, 200 as status_code, at as attempted_at, body as content, 'utf-8' as encoding "
        "from values ('a.md', timestamp '2024-01-01', 'old'), ('a.md', timestamp '2024-01-02', 'new'), "
        "('a.md', timestamp '2024-01-02', 'new'), ('b.md', null, 'big'), ('c.md', null, 'c') as t(path, at, body)"
    )
    got = repository.import_files(items, contents, stamp(), FileOptions(max_size=9))
    assert sorted(r.body for r in got.downloads.collect()) == ["c", "new"] and got.sources.count() == 2
    assert [(r.path, r.error) for r in got.rejects.collect()] == [("b.md", "ErrFileTooLarge")]


def test_contents_and_checkout(spark, tmp_path):
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "one.json").write_text(json.dumps({"name": "a.md", "path": "a.md", "content": "eA==\n", "encoding": "base64"}))
    row = repository.read_contents(spark, str(tmp_path / "c")).first()
    assert (row.path, row.content, row.encoding) == ("a.md", "eA==\n", "base64")
    (tmp_path / "repo" / "src").mkdir(parents=True)
    (tmp_path / "repo" / "src" / "a.py").write_text("hello\n")
    row = repository.read_checkout(spark, str(tmp_path / "repo")).first()
    assert (row.path, row.content, row.size) == ("src/a.py", "hello\n", 6)
    assert row.sha == "ce013625030ba8dba906f756967f9e9ca394464a"


def test_import_files(spark):
    items = spark.createDataFrame(
        [("o", "r", "main", p, "blob", "s", 1) for p in ("a.yaml", "b.md", "c.md", "d.png")],
        "owner string, repo string, ref string, path string, type string, sha string, size bigint",
    )
    contents = spark.createDataFrame(
        [("o", "r", "main", "a.yaml", 200, None, "eA==", "base64"), ("o", "r", "main", "b.md", 404, None, None, None)],
        "owner string, repo string, ref string, path string, status_code int, attempted_at timestamp, content string, encoding string",
    )
    got = repository.import_files(items, contents, stamp())
    source, download = got.sources.first(), got.downloads.first()
    assert source.raw_url == "https://github.com/o/r/blob/main/a.yaml" and source.format == "yaml"
    assert download.body == "x" and download.headers == '{"Content-Type":["text/plain"],"X-GitHub-SHA":["s"]}'
    assert sorted((r.path, r.error) for r in got.rejects.collect()) == [
        ("b.md", "ErrGitHubAPIRequestFailed"), ("c.md", "ErrNoResponse"),
    ]


def site(url):
    """A small site: three pages of two posts; post 4 fails, post 5 raises."""
    if "?page=" in url:
        page = int(url.split("page=")[1].split("&")[0])
        body = json.dumps([{"id": page * 2 - 1}, {"id": page * 2}]) if page <= 3 else "{}"
        return (200 if page <= 3 else 400), {}, body
    number = int(url.rsplit("/", 1)[1])
    if number == 5:
        raise ConnectionError("down")
    return (500 if number == 4 else 200), {"Content-Type": ["application/json"]}, json.dumps({"id": number})


def test_live_listing_and_items(spark):
    options = ListingOptions(max_pages=20, concurrency=4, pause=0)
    listing = landing.listing_ids(fetch.fetch_listing(spark, "https://a.org/wp-json/posts", site, options))
    assert sorted(r.item_id for r in listing.items.collect()) == [1, 2, 3, 4, 5, 6]
    answered = fetch.fetch_items(listing.items, site, options.concurrency)
    assert answered.rdd.getNumPartitions() == 4
    got = landing.import_items(listing.items, answered, stamp())
    assert got.downloads.count() == 4
    assert sorted(r.error for r in got.rejects.collect()) == ["ErrNoResponse", "ErrUnexpectedPostStatusCode"]


def world(url):
    """Two posts sites and two repositories, one of them missing."""
    if "/git/trees/" in url:
        return (200, {}, json.dumps(TREE)) if "/o/r/" in url else (404, {}, "")
    if "/contents/" in url:
        name = url.split("/contents/")[1].split("?")[0]
        if name == "tool.py":
            return 403, {}, ""
        return 200, {}, json.dumps({"path": name, "content": "aGk=\n", "encoding": "base64"})
    return site(url)


def test_land_from_urls(spark):
    addresses = [
        "https://a.org/wp-json/posts", "https://b.org/wp-json/posts", "https://github.com/o/r",
        "https://github.com/o/gone/tree/v1", "https://c.org/other",
    ]
    df = spark.createDataFrame([(a,) for a in addresses], "raw_url string")
    fetched = live.land(df, world, ListingOptions(max_pages=9, concurrency=3, pause=0))
    assert sorted((r.raw_url, r.error) for r in fetched.rejects.collect()) == [
        ("https://c.org/other", "ErrNoImporterCanHandle"),
        ("https://github.com/o/gone/tree/v1", "ErrGitHubAPIRequestFailed"),
    ]
    got = ingest.import_all(fetched.landed, stamp())
    assert got.sources.count() == 2 * 4 + 3
    assert sorted(r.error for r in got.rejects.collect()) == ["ErrGitHubAPIRequestFailed"] + ["ErrNoResponse"] * 2 + [
        "ErrUnexpectedPostStatusCode"
    ] * 2
    assert got.downloads.where("body = 'hi'").count() == 3


def test_a_failed_page_does_not_end_the_walk(spark):
    def shaky(url):
        page = int(url.split("page=")[1].split("&")[0])
        if page == 3:
            raise ConnectionError("down")
        return (200, {}, json.dumps([{"id": page}])) if page <= 40 else (200, {}, "[]")

    for options in (ListingOptions(concurrency=3, pause=0), ListingOptions(concurrency=1, retries=0), ListingOptions(max_pages=60, concurrency=4, pause=0)):
        pages = fetch.fetch_listing(spark, "https://a.org/p", shaky, options)
        got = landing.listing_ids(pages, options.max_pages)
        assert sorted(r.item_id for r in got.items.collect()) == [n for n in range(1, 41) if n != 3]
        assert [(r.page, r.error) for r in got.rejects.collect()] == [(3, "ErrNoResponse")]
    same = fetch.fetch_listing(spark, "https://a.org/p", lambda url: (200, {}, '[{"id": 1}]'), ListingOptions(concurrency=2))
    assert same.count() == 4
    cut = landing.listing_ids(fetch.fetch_listing(spark, "https://a.org/p", shaky, ListingOptions(max_pages=10, pause=0)), 10)
    assert cut.items.count() == 9 and "ErrListingCut" in {r.error for r in cut.rejects.collect()}
