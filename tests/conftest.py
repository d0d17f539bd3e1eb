import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from salesflow.catalog import base  # noqa: E402
from salesflow.session import build_session  # noqa: E402

base.PART_ROWS = 300  # several micro-batches on the small tables, too

TEST_DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", master="local[8]", shuffle_partitions=4, spark__ui__enabled="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__ui__showConsoleProgress="false")
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return TEST_DATA


@pytest.fixture()
def folder(tmp_path):
    """A new folder name below the test's own folder."""
    made = iter(range(1000))
    return lambda name="f": str(tmp_path / f"{name}{next(made)}")
