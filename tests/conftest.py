from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from crosstally.session import local_session

    scratch = tmp_path_factory.mktemp("spark")
    session = local_session(
        4,
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(scratch / "checkpoints"),
            "spark.sql.warehouse.dir": str(scratch / "warehouse"),
        },
    )
    yield session
    session.stop()
