import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from factloom.session import build_session  # noqa: E402
from factloom.sources import seeds  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        master="local[4]",
        spark__sql__shuffle__partitions="4",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__driver__memory="4g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def seed(spark):
    return seeds.synonyms(spark)


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def medium():
    return "/root/testdata/sf0.01"
