import sys
from datetime import date
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from stardw.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores="4", app="stardw-tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    return lambda rows, ddl: spark.createDataFrame(rows, ddl)


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def same_rows(a, b):
    return a.exceptAll(b.select(*a.columns)).isEmpty() and b.select(*a.columns).exceptAll(
        a
    ).isEmpty()


D = date.fromisoformat
