import os
import sys
from datetime import date, timedelta
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tallycast.session import local_session  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "tests")
    yield session
    session.stop()


@pytest.fixture
def series(spark):
    """Build (series, date, value) rows from lists of values, one per day."""

    def build(start=date(2020, 3, 1), **values):
        rows = [
            (k, start + timedelta(days=i), None if v is None else float(v))
            for k, vs in values.items()
            for i, v in enumerate(vs)
        ]
        return spark.createDataFrame(rows, "series string, date date, value double")

    return build


def column(df, *cols, order=("date",)):
    return [tuple(r) if len(cols) > 1 else r[0] for r in df.orderBy(*order).select(*cols).collect()]
