import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from dimflow import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def d(text):
    return dt.date.fromisoformat(text) if text else None


@pytest.fixture(scope="session")
def day():
    return d


def rows(df, *cols):
    """Sorted tuples of the named columns."""
    picked = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


@pytest.fixture(scope="session")
def as_rows():
    return rows
