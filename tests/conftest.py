import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from noticeworks.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def apply(spark):
    """Values of a column function over one string column."""
    from pyspark.sql import functions as F

    def run(fn, values):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
        out = fn(F.col("c"))
        return [r["r"] for r in df.select("i", out.alias("r")).orderBy("i").collect()]

    return run
