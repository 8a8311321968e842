import sys

import pytest
from places import ROOT

sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from tidehaul.session import build_session

    session = build_session(
        "tests",
        "local[8,4]",
        spark_sql_shuffle_partitions="8",
        spark_driver_memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
