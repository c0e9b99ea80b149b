"""Functions for executors run where this package is not installed."""

import subprocess
import sys

from pyspark import cloudpickle
from pyspark.sql import functions as F

from corpusflow.operators import embed as embedding
from corpusflow.options import ListingOptions
from corpusflow.sources import fetch


def loads_alone(function, folder):
    code = "import pickle, sys; pickle.load(sys.stdin.buffer); sys.exit('corpusflow' in sys.modules)"
    run = subprocess.run([sys.executable, "-I", "-c", code], input=cloudpickle.dumps(function), cwd=folder, capture_output=True)
    return run.returncode == 0


def test_no_package_needed(spark, monkeypatch, tmp_path):
    shipped = []
    df = spark.createDataFrame([("https://a.org/p", "id", "body")], "base_url string, id string, body string")
    for name in ("mapInPandas", "mapInArrow"):
        real = getattr(type(df), name)
        monkeypatch.setattr(type(df), name, lambda self, function, schema, real=real: shipped.append(function) or real(self, function, schema))

    def answer(url):
        return 200, {}, "[]"

    fetch.fetch_pages(df, answer, ListingOptions(per_page=3, max_pages=7, concurrency=2))
    fetch.fetch_items(df.withColumn("item_url", F.col("base_url")), answer, 2)
    embedding.embed(df, embedding.Embedder("m", 2, 10, len))
    assert len(shipped) == 3 and all(loads_alone(function, tmp_path) for function in shipped)
