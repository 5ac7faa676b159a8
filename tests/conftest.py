import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from seriesflow.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = local_session(
        8,
        4,
        **{"spark.checkpoint.dir": f"file://{base}/scratch", "spark.sql.warehouse.dir": f"file://{base}/warehouse"},
    )
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Rows of a DataFrame as a sorted list of tuples."""

    def collect(df, *columns):
        return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)

    return collect
