import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakeops.session import build_session, configure  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("lakeops-tests", 8)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(autouse=True)
def _settings(spark):
    configure(spark)
    yield
