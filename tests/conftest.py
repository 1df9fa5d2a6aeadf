import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from newsloom.operators.lookup import Limits  # noqa: E402
from newsloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g",
        "spark.ui.showConsoleProgress": "false",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(params=["broadcast", "split"])
def limits(request):
    """Once with room to broadcast, once with none: the result must not differ."""
    return Limits() if request.param == "broadcast" else Limits(table_bytes=0, heavy_keys=5)


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)
