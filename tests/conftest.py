import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
for folder in (ROOT, ROOT / "tests"):
    if str(folder) not in sys.path:
        sys.path.insert(0, str(folder))

from tidemark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, 4, "tidemark-tests")
    session.sparkContext.setLogLevel("ERROR")
    # Tests move a handful of rows: compiling each plan would take most of the time.
    session.conf.set("spark.sql.codegen.wholeStage", "false")
    session.conf.set("spark.sql.shuffle.partitions", "2")
    yield session
    session.stop()


@pytest.fixture
def capture_root(tmp_path):
    return str(tmp_path / "capture")


@pytest.fixture
def store(spark, tmp_path):
    from tidemark.sources.warehouse import Warehouse

    return Warehouse(spark, str(tmp_path / "warehouse"))
