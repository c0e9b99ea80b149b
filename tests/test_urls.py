from pyspark.sql import functions as F

from corpusflow.functions import paths, urls
from corpusflow.plans import parts


def test_post_endpoint(values):
    good = ["https://news.test/wp-json/wp/v2/media", "http://w.test/de/wp-json/", "https://w.test/wp-json/wp/v2/pages?page=4&order=asc"]
    bad = ["https://news.test/feed.xml", "https://w.test/wp_json", "http//no-scheme", None]
    assert values(good + bad, urls.is_post_endpoint) == [True] * 3 + [False] * 4


def test_url_parts(spark):
    df = spark.createDataFrame(
        [("HTTPS://me:pw@example.com:8443/a%20b/c+d?x=1&y#frag",), ("https://example.com",)], "raw_url string"
    )
    first, second = urls.with_url_parts(df).collect()
    assert (first.scheme, first.host, first.path, first.query) == ("https", "example.com:8443", "/a b/c+d", "x=1&y")
    assert (second.scheme, second.host, second.path, second.query) == ("https", "example.com", "", "")


def test_malformed_escape_is_an_error(values):
    assert values(["https://github.com/a%zz/b"], urls.path) == [None]


def test_repository_urls(spark):
    cases = {
        "https://github.com/ada/engine": ("ada", "engine", "main", None),
        "https://github.com/ada/engine/tree/notes-2": ("ada", "engine", "notes-2", None),
        "https://github.com/x1/y2/": ("x1", "y2", "main", None),
        "https://api.github.com/gists/77": ("gists", "77", "main", None),
        "https://codeberg.test/ada/engine": (None, None, None, "ErrNotGitHubURL"),
        "https://github.com/ada/": (None, None, None, "ErrInvalidGitHubURLFormat"),
        "https://github.com//engine": (None, None, None, "ErrInvalidGitHubURLFormat"),
        "http//no-scheme": (None, None, None, "ErrNotGitHubURL"),
    }
    df = spark.createDataFrame([(u,) for u in cases], "raw_url string")
    got = {r.raw_url: (r.owner, r.repo, r.ref, r.repo_error) for r in urls.with_repo(df).collect()}
    assert got == cases


def test_routing(spark):
    df = spark.createDataFrame(
        [("https://github.com/o/r",), ("https://a.org/wp-json/x",), ("https://a.org/x",)], "raw_url string"
    )
    rows = urls.route_import(df).withColumn("by_parts", parts.source_type(F.col("raw_url"))).collect()
    assert [r.source_type for r in rows] == ["github", "wp-json", None]
    assert [r.by_parts for r in rows] == ["github", "wp-json", None]
    assert rows[2].error == "ErrNoImporterCanHandle"


def test_stored_routing(values):
    hosts = ["github.com", "api.github.com", "example.com", None]
    assert values(hosts, urls.stored_source_type) == ["github", "github", "wp-json", None]
    assert values(hosts, urls.stored_source_error) == [None, None, None, "ErrCannotDetermineSourceType"]


def test_file_path(values):
    base = "https://github.com/ada/engine/"
    cases = {
        base + "blob/dev/lib/gears/wheel.rs": "lib/gears/wheel.rs",
        base + "blob/dev/LICENSE": "LICENSE",
        base + "blob/fix/typo/notes.txt": "typo/notes.txt",
        base + "raw/dev/a.txt": "",
        "https://github.com/ada": "",
        "": "",
    }
    assert values(list(cases), paths.file_path) == list(cases.values())


def test_repository_of_blob_url(values):
    url = ["https://github.com/o/r/blob/fix/typo/wheel.rs", "https://github.com/o/r/commits/main", "https://x"]
    assert values(url, paths.branch) == ["fix/typo", None, None]
    assert values(url, paths.owner) == ["o", "o", None]


def test_path_pieces(values):
    names = ["lib/wheel.rs", ".profile", "v1.2/NOTES", "data.csv.zst", ""]
    assert values(names, paths.extension) == [".rs", ".profile", "", ".zst", ""]
    assert values(names, paths.base_name) == ["wheel.rs", ".profile", "NOTES", "data.csv.zst", "."]
    assert values(names, paths.directory) == ["lib", None, "v1.2", None, None]


def test_exclusions_and_extensions(values):
    names = ["deep/.git/HEAD", "node_modules/left/pad.js", "x/.DS_Store", "lib/distance.py", "NOTES.Md"]
    assert values(names, paths.is_excluded) == [True, True, True, True, False]
    assert values(names, lambda c: paths.is_excluded(c, match="segment")) == [True, True, True, False, False]
    assert values(["NOTES.Md", "wheel.py", "Justfile", "logo.gif", "run.bin"], paths.is_importable) == [True, True, False, False, False]


def test_code_language(values):
    assert values([".go", ".py", ".js", ".sql", ".md"], paths.code_language) == ["", "python", "javascript", "sql", None]
