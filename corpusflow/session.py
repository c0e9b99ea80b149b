"""Spark session settings and the shared work folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession

#: Settings every job relies on; everything else is the cluster's choice.
JOB_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Where one side of a join is narrow, hash it instead of sorting the bodies of the other.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Filters reach the sources of sources.api, which refuse to run without.
    "spark.sql.python.filterPushdown.enabled": "true",
    # Repeated keys in a JSON object: the last one counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def build_session(app: str = "corpusflow", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**JOB_SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


@lru_cache(maxsize=1)
def _local_dir() -> str:
    folder = tempfile.mkdtemp(prefix="corpusflow-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


#: Folders of this process's intermediate results.
_WRITTEN: list[str] = []


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder.

    Only a local session may fall back to a temporary folder: on a cluster,
    executors on other machines could not read it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder all executors share")
        base = _local_dir()
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


#: Bodies and ids are most of what is written, and a third smaller so.
COMPRESSION = {"compression": "zstd"}
_FREEING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Jobs in here delete what they shuffled when they end.

    What they wrote is read from then on, so nothing asks for the shuffles again; Spark would keep them until the
    driver's memory happens to be cleaned, which large tables bring on no sooner than small ones.
    """
    before = spark.conf.get(_FREEING, None)
    spark.conf.set(_FREEING, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREEING)
        else:
            spark.conf.set(_FREEING, before)


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write once and read back, so several consumers share one computation.

    The written table outlives lost executors, and its statistics let Spark
    choose the join strategy of what follows by real size.
    """
    path = work_dir(df.sparkSession, purpose)
    with shuffles_freed(df.sparkSession):
        df.write.options(**COMPRESSION).parquet(path)
    _WRITTEN.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def counted(df: DataFrame, purpose: str, metrics: dict[str, Column]) -> tuple[DataFrame, dict[str, int]]:
    """materialize, with aggregates over the rows taken while they are written: no second reading for them."""
    seen = Observation()
    table = materialize(df.observe(seen, *[column.alias(name) for name, column in metrics.items()]), purpose)
    try:
        found = seen.get
    except Py4JJavaError:
        # Spark left out a plan that it knows to have no rows, and the node that counts with it.
        found = {}
    return table, {name: found.get(name) or 0 for name in metrics}


def discard_work(spark: SparkSession, since: int = 0, purpose: str = "") -> None:
    """Delete all intermediate results so far; what was computed from them must be stored by then.

    ``since`` leaves out those written before, of which there were so many, and ``purpose`` those of others.
    """
    for folder in [f for f in _WRITTEN[since:] if f.rpartition("/")[2].startswith(purpose)]:
        _WRITTEN.remove(folder)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written_so_far() -> int:
    """How many intermediate results there are, for discard_work."""
    return len(_WRITTEN)
