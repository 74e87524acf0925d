import os
import sys
import tempfile

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from linguamart.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="linguamart-tests-"),
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="linguamart-tests-"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Sorted rows of a DataFrame as plain tuples."""
    def collect(df, *columns):
        got = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
        return sorted(got, key=lambda r: tuple((v is None, str(v)) for v in r))

    return collect
