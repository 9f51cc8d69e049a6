from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from retrocohort.session import build_session  # noqa: E402
from retrocohort.staging import Lookup  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    stages = str(tmp_path_factory.mktemp("stages"))
    session = build_session("tests", shuffle_partitions=4, driver_memory="4g", checkpoint_dir=stages)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """A DataFrame from rows and a DDL schema; dates may be given as text."""

    def make(rows, schema):
        names = [part.strip().split(" ")[0] for part in schema.split(",")]
        kinds = [part.strip().split(" ")[1] for part in schema.split(",")]
        text = ", ".join(
            f"{n} {'string' if k in ('date', 'timestamp') else k}" for n, k in zip(names, kinds, strict=True)
        )
        df = spark.createDataFrame(rows, text)
        return df.select(*[df[n].cast(k).alias(n) for n, k in zip(names, kinds, strict=True)])

    return make


@pytest.fixture(params=[True, False], ids=["broadcast", "shuffle"])
def side(request):
    """Wraps a table as a lookup, once small enough to broadcast and once not."""
    return lambda df: Lookup(df, request.param)


def rows(df):
    """Rows as sorted tuples, dates as text."""
    import datetime

    def plain(value):
        return value.isoformat() if isinstance(value, datetime.date) else value

    return sorted((tuple(plain(v) for v in row) for row in df.collect()), key=repr)
