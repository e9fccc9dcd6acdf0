import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from strataloom import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[8]", app="tests", shuffle_partitions=8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def plan_of():
    """Physical plan text of a frame after a run, so that AQE has decided."""

    def text(df, run=False):
        if run:
            df.write.format("noop").mode("overwrite").save()
        return df._jdf.queryExecution().executedPlan().toString()

    return text
