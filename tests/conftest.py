import re

import pytest
from pyspark.sql import functions as F

from almoner.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", 8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Values of a column expression over literal input."""

    def run(values, expression, kind="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
        return [r["out"] for r in df.orderBy("i").select(expression(F.col("v")).alias("out")).collect()]

    return run


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def moved_columns(df) -> list[list[str]]:
    """Names of the columns that each shuffle of a plan carries."""
    jvm = df.sparkSession._jvm
    mode = jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    told = df._jdf.queryExecution().explainString(mode)
    return [re.findall(r"(\w+)#", found) for found in re.findall(r"\) Exchange *\nInput \[\d+\]: \[(.*)\]", told)]


def edit_distance(a: str, b: str) -> int:
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(last[j] + 1, now[-1] + 1, last[j - 1] + (x != y)))
        last = now
    return last[-1]
