import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tideline.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", app="tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


def ts(text):
    return None if text is None else dt.datetime.fromisoformat(text)


def day(text):
    return None if text is None else dt.date.fromisoformat(text)


def rows(df, *order):
    return [tuple(row) for row in (df.orderBy(*order) if order else df).collect()]
