import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from loomgrain.session import build_session  # noqa: E402

FOLDER = os.environ.get("LOOMGRAIN_TEST_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", 8, {"spark.driver.memory": "6g", "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture(scope="session")
def tables(spark, folder):
    from loomgrain.queries.registry import Tables

    return Tables(spark, folder)


def rows(df, columns=None):
    """Rows as sorted tuples, columns in a fixed order."""
    columns = columns or sorted(df.columns)
    found = [tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect()]
    return sorted(found, key=lambda r: tuple((v is not None, str(v)) for v in r))
