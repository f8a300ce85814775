import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from salesloom.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[8]", 8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder():
    """A new folder for every test."""
    return tempfile.mkdtemp(prefix="salesloom-test-")


@pytest.fixture
def store(spark, folder):
    from salesloom.sources.store import Store

    return Store(spark, folder)


@pytest.fixture(scope="session")
def sample(spark):
    """The warehouse over the smallest test tables."""
    from salesloom.plans import catalog

    return catalog.warehouse(spark, SF_DIR)


def rows(df):
    return [tuple(r) for r in df.collect()]


def plan_of(df, mode="formatted"):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)
