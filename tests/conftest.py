from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from storelens.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="6g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def values(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
