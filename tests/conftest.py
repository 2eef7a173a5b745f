import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from claimloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    work = str(tmp_path_factory.mktemp("work"))
    session = local_session(
        8, "claimloom-tests", **{"spark.driver.memory": "6g", "spark.checkpoint.dir": work, "spark.sql.warehouse.dir": f"{work}/warehouse"}
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows():
    """Rows of a frame as a sorted list of tuples (nulls last, floats rounded)."""

    def collect(df, *columns, digits=4):
        df = df.select(*columns) if columns else df
        out = [tuple(round(v, digits) if isinstance(v, float) else v for v in r) for r in df.collect()]
        return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))

    return collect
