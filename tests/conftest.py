from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))



@pytest.fixture(scope="session")
def spark():
    from quire.session import build_session

    s = build_session("local[4]", app_name="quire-tests", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture()
def scratch(tmp_path):
    return str(tmp_path)
