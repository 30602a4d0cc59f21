from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallystar.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    session = local_session(
        "8",
        "tallystar-tests",
        **{"spark.checkpoint.dir": f"{home}/shared", "spark.sql.warehouse.dir": f"{home}/warehouse"},
    )
    yield session
    session.stop()
