import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))

from corpusflow.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "6g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Evaluate column expressions over one text column: values(["a", None], lambda c: ...)."""
    from pyspark.sql import functions as F

    def run(rows, make, ddl="string"):
        df = spark.createDataFrame([(i, row) for i, row in enumerate(rows)], f"i int, x {ddl}")
        return [row[0] for row in df.orderBy("i").select(make(F.col("x")).alias("y")).collect()]

    return run
