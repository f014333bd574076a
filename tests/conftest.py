import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from plumbtable.session import local_session  # noqa: E402

NUMERIC = ["X1", "X3", "X5", "X7"]
CATEGORICAL = ["X6", "X8"]
MINI_SCHEMA = (
    "row_id int, X1 double, X2 string, X3 double, X4 string, X5 int, X6 string, X7 int, X8 int, Y1 double, Y2 double"
)
MINI_ROWS = [
    (0, 10.0, "1", 1.1, "$10", 0, "A", 5, 1, 25.0, 15.0),
    (1, 20.0, "2", 2.2, "$20", 0, "B", 6, 1, 35.0, 25.0),
    (2, 30.0, "3", None, "$30", 0, "A", 7, 2, 45.0, 35.0),
    (3, 40.0, "4", 4.4, "$40", 1, "C", 8, 2, 55.0, 45.0),
    (4, 50.0, "5", 5.5, "$50", 1, "A", 9, 3, 65.0, 55.0),
    (5, 1000.0, "6", 6.6, "$60", 1, "B", 10, 3, 75.0, 65.0),
    (6, -100.0, "7", 7.7, "$70", 2, "Z", 11, 4, 85.0, 75.0),
    (7, None, "8", 8.8, "$80", 2, "Z", 12, 4, 95.0, 85.0),
    (8, 10.0, "1", 1.1, "$10", 0, "A", 5, 1, 25.0, 15.0),
]


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4, app="plumbtable-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture
def mini(spark):
    return spark.createDataFrame(MINI_ROWS, MINI_SCHEMA)


def ids(df):
    return sorted(r["row_id"] for r in df.select("row_id").collect())


def by(df, key):
    return {r[key]: r.asDict() for r in df.collect()}
