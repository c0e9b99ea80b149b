import base64
import json

from pyspark.sql import functions as F

from corpusflow.functions import times
from corpusflow.operators import files, posts
from corpusflow.operators.metadata import json_text

FULL = {
    "id": 7,
    "content": {"rendered": "<p>See <a href='https://e.org'>it</a></p>"},
    "title": {"rendered": " A &amp; B "},
    "excerpt": {"rendered": "<p>Short <b>one</b></p>"},
    "date_gmt": "2023-01-01T10:30:00",
    "modified_gmt": "2023-01-02T10:30:00",
    "link": "https://e.org/a",
    "author": 3.7,
    "status": "publish",
    "type": "post",
    "slug": "a",
    "featured_media": "5",
    "categories": [1, 2],
    "tags": [],
}


def without(*keys, **changes):
    return json.dumps({k: v for k, v in {**FULL, **changes}.items() if k not in keys})


def test_post_predicate(values):
    bodies = [json.dumps(FULL), *[without(k) for k in ("content", "title", "date_gmt", "modified_gmt")]]
    bodies += [without(title=None), None, "", "{bad", "[1]", json.dumps(FULL) + ",", json.dumps(FULL) + " {}", json.dumps(FULL) + ',"end of body"] junk']
    got = values(bodies, lambda c: posts.is_post(posts.parsed(c)))
    assert got == [True] + [False] * 4 + [True] + [False] * 7


def test_content_errors(values):
    bodies = [
        without("content"), without(content=["body"]), without(content={"raw": "none"}),
        without(content={"rendered": [7.5]}), without(),
    ]
    assert values(bodies, lambda c: posts.content_error(posts.parsed(c))) == [
        "ErrNoContentField", "ErrContentFieldNotObject", "ErrNoRenderedContent", "ErrRenderedContentNotString", None,
    ]


def test_dates(values):
    bodies = [without(), without(date_gmt="31 May, noon"), without(date_gmt=5), without(modified_gmt=None)]
    assert values(bodies, lambda c: posts.date_error(posts.parsed(c))) == [None, "ErrParseDate", None, None]
    assert values(bodies[:1], lambda c: times.format_utc(posts.dates(posts.parsed(c))["published_at"])) == [
        "2023-01-01T10:30:00Z"
    ]


def test_post_transform(spark):
    df = spark.createDataFrame([("ok", without()), ("bad", "[]")], "id string, body string")
    rows = {r.id: r for r in posts.transform(df).collect()}
    assert rows["ok"].content == "See [it](https://e.org)"
    assert rows["ok"].metadata == {
        "document_title": "A &amp; B", "document_description": "Short **one**", "links_count": "1",
        "canonical_url": "https://e.org/a", "author_id": "3", "status": "publish", "post_type": "post", "slug": "a",
        "categories": "[1,2]", "tags": "[]",
    }
    assert rows["bad"].error == "ErrCannotTransformWPDownload" and rows["bad"].metadata is None
    quoted = posts.transform(df, quote_strings=True).where("id = 'ok'").first().metadata
    assert quoted["slug"] == '"a"' and quoted["links_count"] == "1"


def test_terms(values):
    body = json.dumps({"_embedded": {"wp:term": [[{"name": "a"}, {"name": "b"}], [{"name": "c", "id": 1}]]}})
    assert values([body, "{}"], lambda c: posts.terms(posts.parsed(c))) == [["a", "b", "c"], None]


def test_json_text(values):
    assert values(['a "b"\n', "é"], json_text) == ['"a \\"b\\"\\n"', '"é"']


def test_file_predicate(spark):
    rows = [
        ('{"X-GitHub-SHA":["abc"],"Content-Type":["text/plain"]}', "x"), ('{"x-github-sha":["abc"]}', "x"),
        ("{}", "x"), ("bad", "x"), ('{"X-GitHub-SHA":["abc"]}', None),
    ]
    df = spark.createDataFrame(rows, "h string, b string")
    got = [r[0] for r in df.select(files.is_file_download(F.col("h"), F.col("b"))).collect()]
    assert got == [True, False, False, False, False]


def process(spark, name, body, **options):
    df = spark.createDataFrame(
        [(f"https://github.com/o/r/blob/main/{name}", body, '{"X-GitHub-SHA":["a"]}', options.pop("encoding", None))],
        "raw_url string, body string, headers string, encoding string",
    )
    return files.transform(df, encoding="encoding", **options).first()


def test_file_content(spark):
    fence = "```{}\n{}\n```".format
    cases = {
        ("a.md", "# T"): "# T",
        ("a.go", "x"): fence("go", "x"),
        ("a.py", "x"): fence("python", "x"),
        ("a.cpp", "x"): fence("cpp", "x"),
        ("a.yaml", "a: 1"): fence("yaml", "a: 1"),
        ("a.txt", "RsO8bmYgRsO8w59l"): fence("", "RsO8bmYgRsO8w59l"),
        ("a.xyz", "x"): "x",
        ("a.html", "<h2>Rain</h2>\n<p>It <em>fell</em> all night.</p>"): "## Rain\n\nIt _fell_ all night.",
        ("a.rst", "x"): "x",
    }
    for (name, body), expected in cases.items():
        assert process(spark, name, body).content == expected


def test_encodings(spark):
    text = base64.b64encode(b"x = 1").decode()
    assert process(spark, "a.py", text, encoding="base64").content == "```python\nx = 1\n```"
    # Parity: decoded only when the text mentions the word, and then left unfenced on failure.
    assert process(spark, "a.py", text, encoding="base64", parity=True).content == f"```python\n{text}\n```"
    assert process(spark, "a.py", "import base64", parity=True).content == "import base64"
    assert process(spark, "a.py", "import base64").content == "```python\nimport base64\n```"
    assert process(spark, "a.PY", "x").content == "```python\nx\n```"
    assert process(spark, "a.PY", "x", parity=True).content == "x"


def test_file_metadata(spark):
    row = process(spark, "src/lib/a.py", "é\n")
    assert row.metadata == {
        "file_path": "src/lib/a.py", "file_name": "a.py", "file_extension": ".py", "content_type": "code",
        "programming_language": "python", "directory": "src/lib", "file_size": "17", "character_count": "17",
        "line_count": "4", "repository": '{"branch":"main/src/lib","owner":"o","repo":"r"}',
    }
    assert row.language == "python" and row.format == "json"
    text_row = process(spark, "a.md", "hello")
    assert text_row.metadata["natural_language"] == "en" and "programming_language" not in text_row.metadata
    assert process(spark, "a.md", "x", quote_strings=True).metadata["file_name"] == '"a.md"'
