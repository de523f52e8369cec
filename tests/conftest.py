import itertools
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from strata.session import build_session
from strata.sources.target import Target

_ids = itertools.count()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        "strata-tests",
        8,
        **{
            "spark.sql.warehouse.dir": str(base / "warehouse"),
            "spark.checkpoint.dir": str(base / "checkpoints"),
            "spark.sql.shuffle.partitions": "4",
            "spark.default.parallelism": "4",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def target(spark, tmp_path):
    return Target(spark, str(tmp_path / "built"), f"t{next(_ids)}_").setup()


@pytest.fixture
def landing(tmp_path):
    root = tmp_path / "landing"
    root.mkdir()
    return root
