import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from upswell.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        **{
            "spark.master": "local[8]", "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
            "spark.driver.memory": "6g", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Value of an expression over one row of literals."""

    def run(build, *values):
        from pyspark.sql import functions as F

        df = spark.createDataFrame([tuple(values)], ", ".join(f"c{i} string" for i in range(len(values))))
        return df.select(build(*[F.col(f"c{i}") for i in range(len(values))]).alias("out")).first().out

    return run


@pytest.fixture
def column(spark):
    """Values of an expression over a list of strings, in order."""

    def run(build, values):
        from pyspark.sql import functions as F

        df = spark.createDataFrame(list(enumerate(values)), "i int, c string")
        return [r.out for r in df.select("i", build(F.col("c")).alias("out")).orderBy("i").collect()]

    return run
