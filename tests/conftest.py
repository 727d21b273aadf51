import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [HERE, os.path.dirname(HERE)]

from tallyfold.session import local_session, new_folder  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    return local_session(8, "tests")


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def folder(spark):
    return new_folder(spark, "test")


@pytest.fixture
def lines(spark):
    """Build (file, value) from {file: text}."""

    def build(**files):
        rows = [(f, v) for f, text in files.items() for v in text.split("\n")]
        return spark.createDataFrame(rows, "file string, value string").repartition(3)

    return build


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


@pytest.fixture(scope="session", name="rows")
def rows_fixture():
    return rows
