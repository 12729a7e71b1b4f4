from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]

from skytune.session import local_session  # noqa: E402

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("shared")
    session = local_session(
        "4",
        4,
        **{
            "spark.checkpoint.dir": str(root / "checkpoints"),
            "spark.sql.warehouse.dir": str(root / "warehouse"),
        },
    )
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Rows as tuples to a frame: rows("a int, b string", (1, "x"), ...)."""

    def build(schema: str, *values: tuple):
        return spark.createDataFrame(list(values), schema)

    return build


def executed(df) -> str:
    """Text of the plan that ran, after runtime re-planning."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
