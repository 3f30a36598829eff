from __future__ import annotations

import pathlib
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from leadloom.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = local_session(4, app="tests", **{"spark.checkpoint.dir": str(shared)})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def change(**options):
        for key, value in options.items():
            name = key.replace("__", ".")
            before.setdefault(name, spark.conf.get(name))
            spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL
