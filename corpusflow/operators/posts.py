"""Posts: JSON bodies to content, dates and metadata.

The body is parsed once into a variant; every check and field reads from it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow import fixed
from corpusflow.functions import text, times
from corpusflow.functions.markdown import html_to_markdown
from corpusflow.operators.barrier import computed_once
from corpusflow.operators.metadata import json_text, present

DATE_KEYS = {"published_at": "date_gmt", "modified_at": "modified_gmt"}


def parsed(body: Column) -> Column:
    """The body as a variant if it is one JSON object and nothing after it, else null.

    The parser stops behind the first value, so the body is read as the first of two
    list entries: text behind the object breaks the list. The second entry is the
    body's hash, which a body cannot bring along, and there is no third.
    """
    return _object_in(_pair(body), body)


def _end(body: Column) -> Column:
    return F.concat(F.lit("end of "), F.sha2(body, 256))


def _pair(body: Column) -> Column:
    return F.try_parse_json(F.concat(F.lit("["), body, F.lit(',"'), _end(body), F.lit('"]')))


def _object_in(pair: Column, body: Column) -> Column:
    whole = (F.try_variant_get(pair, "$[1]", "string") == _end(body)) & F.try_variant_get(pair, "$[2]", "variant").isNull()
    return F.when(whole & (kind(pair, "$[0]") == "OBJECT"), F.try_variant_get(pair, "$[0]", "variant"))


def with_parsed(df: DataFrame, body: Column, name: str = "_post") -> DataFrame:
    """Add the parsed body, parsed once per row however often it is read."""
    read = computed_once(df, {"_pair": _pair(body)})
    return computed_once(read, {name: _object_in(F.col("_pair"), body)}).drop("_pair")


def has_key(post: Column, key: str) -> Column:
    """A key counts when present, even with a null value."""
    return F.try_variant_get(post, f"$.{key}", "variant").isNotNull()


def kind(post: Column, path: str) -> Column:
    """JSON kind at a path: OBJECT, ARRAY, STRING, BIGINT, DOUBLE, ...; null when absent."""
    return F.regexp_extract(F.schema_of_variant(F.try_variant_get(post, path, "variant")), "^[A-Z]+", 0)


def is_post(post: Column) -> Column:
    check = post.isNotNull()
    for key in fixed.POST_REQUIRED_KEYS:
        check = check & has_key(post, key)
    return F.coalesce(check, F.lit(False))


def content_error(post: Column) -> Column:
    """Why the content of a JSON object is not usable."""
    return (
        F.when(~has_key(post, "content"), "ErrNoContentField")
        .when(kind(post, "$.content") != "OBJECT", "ErrContentFieldNotObject")
        .when(kind(post, "$.content.rendered").isNull(), "ErrNoRenderedContent")
        .when(kind(post, "$.content.rendered") != "STRING", "ErrRenderedContentNotString")
    )


def text_at(post: Column, path: str) -> Column:
    """String at a path; null for any other kind."""
    return F.when(kind(post, path) == "STRING", F.try_variant_get(post, path, "string"))


def whole_number_at(post: Column, path: str) -> Column:
    """JSON number cut to an integer; strings and other kinds are ignored."""
    numeric = kind(post, path).isin("BIGINT", "DECIMAL", "DOUBLE")
    return F.when(numeric, F.try_variant_get(post, path, "double").cast("bigint"))


def array_at(post: Column, path: str) -> Column:
    """JSON text of an array; null for any other kind."""
    return F.when(kind(post, path) == "ARRAY", F.to_json(F.try_variant_get(post, path, "variant")))


def date_error(post: Column) -> Column:
    bad = F.lit(False)
    for key in DATE_KEYS.values():
        raw = text_at(post, f"$.{key}")
        bad = bad | (raw.isNotNull() & times.parse_post_time(raw).isNull())
    return F.when(bad, "ErrParseDate")


def post_error(post: Column) -> Column:
    return F.coalesce(
        F.when(~is_post(post), "ErrCannotTransformWPDownload"), content_error(post), date_error(post)
    )


def dates(post: Column) -> dict[str, Column]:
    return {name: times.parse_post_time(text_at(post, f"$.{key}")) for name, key in DATE_KEYS.items()}


def metadata(post: Column, content: Column, excerpt_markdown: Column, quote_strings: bool = False) -> Column:
    """Map of the fields that are present with the right JSON kind."""
    strings = {
        "document_title": text.trimmed(text_at(post, "$.title.rendered")),
        "document_description": text.trimmed(excerpt_markdown),
        "canonical_url": text_at(post, "$.link"),
        "status": text_at(post, "$.status"),
        "post_type": text_at(post, "$.type"),
        "slug": text_at(post, "$.slug"),
    }
    if quote_strings:
        strings = {name: F.when(value.isNotNull(), json_text(value)) for name, value in strings.items()}
    return present(
        {
            **strings,
            "links_count": text.link_count(content).cast("string"),
            "author_id": whole_number_at(post, "$.author").cast("string"),
            "featured_media": whole_number_at(post, "$.featured_media").cast("string"),
            "categories": array_at(post, "$.categories"),
            "tags": array_at(post, "$.tags"),
        }
    )


def terms(post: Column) -> Column:
    """Names of all embedded terms, over all taxonomies, in order."""
    groups = F.try_variant_get(post, '$._embedded["wp:term"]', "array<array<struct<name:string>>>")
    return F.transform(F.flatten(groups), lambda term: term["name"])


def transform(downloads: DataFrame, body: str = "body", quote_strings: bool = False) -> DataFrame:
    """Add content, format, dates, metadata and error to post downloads.

    Rows with an error keep null content; nothing is dropped.
    """
    staged = with_parsed(downloads, F.col(body))
    staged = staged.withColumn("error", post_error(F.col("_post")))
    good = F.col("error").isNull()
    post = F.col("_post")
    staged = staged.withColumns(
        {
            "content": html_to_markdown(F.when(good, text_at(post, "$.content.rendered"))),
            "_excerpt": html_to_markdown(F.when(good, text_at(post, "$.excerpt.rendered"))),
        }
    )
    return staged.withColumns(
        {
            "format": F.when(good, "json"),
            **{name: F.when(good, value) for name, value in dates(post).items()},
            "metadata": F.when(good, metadata(post, F.col("content"), F.col("_excerpt"), quote_strings)),
        }
    ).drop("_post", "_excerpt")
