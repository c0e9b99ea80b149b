"""URL parts, repository coordinates and importer routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow import fixed

# RFC 3986, appendix B. Group 2 scheme, 4 authority, 5 path, 7 query.
URI_PATTERN = r"^(([^:/?#]+):)?(//([^/?#]*))?([^?#]*)(\?([^#]*))?(#(.*))?"


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, URI_PATTERN, 2))


def host(url: Column) -> Column:
    """Authority without user info; a port stays."""
    return F.regexp_replace(F.regexp_extract(url, URI_PATTERN, 4), "^.*@", "")


def path(url: Column) -> Column:
    """Percent-decoded path; null when an escape is malformed."""
    raw = F.regexp_extract(url, URI_PATTERN, 5)
    return F.when(~F.contains(raw, F.lit("%")), raw).otherwise(
        F.try_url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))
    )


def query(url: Column) -> Column:
    return F.regexp_extract(url, URI_PATTERN, 7)


def is_parsable(url: Column) -> Column:
    return url.isNotNull() & ~F.startswith(url, F.lit(":")) & path(url).isNotNull()


def with_url_parts(df: DataFrame, url: str = "raw_url") -> DataFrame:
    u = F.col(url)
    return df.withColumns({"scheme": scheme(u), "host": host(u), "path": path(u), "query": query(u)})


def is_post_endpoint(url: Column) -> Column:
    return F.coalesce(is_parsable(url) & F.contains(path(url), F.lit(fixed.POST_PATH_MARK)), F.lit(False))


def with_repo(df: DataFrame, url: str = "raw_url") -> DataFrame:
    """Add owner, repo, ref and the reason a URL is not a repository URL."""
    u = F.col(url)
    out = df.withColumn("_segments", F.split(F.trim(path(u), F.lit("/")), "/"))
    segments = F.col("_segments")
    error = (
        F.when(~is_parsable(u) | u.isNull(), "ErrInvalidURL")
        .when(~host(u).isin(fixed.REPOSITORY_HOSTS), "ErrNotGitHubURL")
        .when(F.size(segments) < 2, "ErrInvalidGitHubURLFormat")
        .when((segments[0] == "") | (segments[1] == ""), "ErrInvalidGitHubURL")
    )
    out = out.withColumn("repo_error", error)
    good = F.col("repo_error").isNull()
    named_ref = (F.size(segments) >= 4) & (F.get(segments, F.lit(2)) == "tree")
    return out.withColumns(
        {
            "owner": F.when(good, F.get(segments, F.lit(0))),
            "repo": F.when(good, F.get(segments, F.lit(1))),
            "ref": F.when(
                good, F.when(named_ref, F.get(segments, F.lit(3))).otherwise(F.lit(fixed.DEFAULT_REF))
            ),
        }
    ).drop("_segments")


def route_import(df: DataFrame, url: str = "raw_url") -> DataFrame:
    """Choose the importer of a URL: repository before posts, else an error code."""
    kind = F.when(F.col("repo_error").isNull(), "github").when(is_post_endpoint(F.col(url)), "wp-json")
    return (
        with_repo(df, url)
        .withColumn("source_type", kind)
        .withColumn("error", F.when(F.col("source_type").isNull(), "ErrNoImporterCanHandle"))
    )


def stored_source_type(host_column: Column) -> Column:
    """Transformer of a stored source: by host; null when the host is unknown."""
    return F.when(host_column.isin(fixed.REPOSITORY_HOSTS), "github").when(host_column.isNotNull(), "wp-json")


def stored_source_error(host_column: Column) -> Column:
    return F.when(host_column.isNull(), "ErrCannotDetermineSourceType")
