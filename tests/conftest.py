import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cyclemart.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("cyclemart-tests", "local[4]", {
        "spark.sql.shuffle.partitions": "4",
        "spark.default.parallelism": "4",
    })
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def scratch(spark):
    from cyclemart.session import scratch_path
    return lambda name="t": scratch_path(spark, name)


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001


def sized(spark, rows, schema: str):
    """A small frame whose size the optimizer knows (a local relation via Arrow)."""
    import pandas as pd

    names = [part.strip().split(" ")[0] for part in schema.split(",")]
    return spark.createDataFrame(pd.DataFrame(rows, columns=names, dtype=object), schema=schema)
