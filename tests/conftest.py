from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from roadweave import build_session  # noqa: E402


@pytest.fixture(scope="session")
def shared(tmp_path_factory) -> str:
    """The folder named by ``spark.checkpoint.dir``, which a running session can't change."""
    return str(tmp_path_factory.mktemp("shared"))


@pytest.fixture(scope="session")
def spark(shared):
    settings = {"spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": shared}
    session = build_session(8, "roadweave-tests", **settings)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """``frame("a int, b string", [(1, "x")])``"""

    def make(schema: str, rows: list[tuple]):
        return spark.createDataFrame(rows, schema)

    return make


def rows(df) -> list[tuple]:
    """Rows as sorted tuples, nulls last."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is None, str(type(v)), v) for v in r])
