from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from premia.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        4,
        "tests",
        **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")), "spark.driver.memory": "4g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df) -> list[tuple]:
    """Sorted rows; nulls first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(c is not None, str(c)) for c in r])
