import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))

from tallgrass.session import session


@pytest.fixture(scope="session")
def spark():
    s = session("local[4]", 4)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def col(spark):
    """Values of a one-column function over single-column rows of text."""

    def run(values, f, kind="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
        from pyspark.sql import functions as F

        return [r.x for r in df.select("i", f(F.col("v")).alias("x")).orderBy("i").collect()]

    return run
