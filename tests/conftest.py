import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from presslake.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, 4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
