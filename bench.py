"""Time the headline queries on local[$BENCH_CPUS]; prints one JSON line.

Each query runs twice and the second run counts: the first one compiles code and
starts Python workers.
"""

from __future__ import annotations

import json
import os
import sys
import time

HEADLINE = [
    "token_count",
    "chunk_fixed",
    "chunk_overlap",
    "chunk_links",
    "chunk_reassembly",
    "chunk_heading",
    "chunk_recursive",
    "language_heuristic",
    "language_profile",
    "language_ngrams",
    "html_to_markdown",
    "post_content",
    "post_metadata",
    "file_content",
    "file_metadata",
    "embed_hash",
    "retention_last3",
    "meta_upsert",
    "tag_upsert",
    "fk_orphans",
    "listing_scan",
    "item_fetch",
    "repository_import",
    "updates_report",
    "updates_apply",
    "stream_ingest",
    "ingest_chunks",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = sys.argv[1:] or HEADLINE

    from corpusflow.checks import QUERIES
    from corpusflow.session import build_session

    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("OFF")

    def run(name: str) -> float:
        begin = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begin

    seconds = {}
    for name in wanted:
        run(name)
        seconds[name] = round(run(name), 3)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
