import json
import os

import pytest

from chartloom.catalog import Catalog
from chartloom.session import build_session

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "chartloom-tests",
        "local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def catalog():
    return Catalog.builtin()


@pytest.fixture
def lines(spark):
    """Documents given as dicts or texts, as a frame with a `value` column."""

    def make(*documents, **columns):
        texts = [d if isinstance(d, str) else json.dumps(d) for d in documents]
        rows = [(text, *columns.values()) for text in texts]
        return spark.createDataFrame(rows, ["value", *columns])

    return make
