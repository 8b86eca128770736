from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from bazaarlens.session import local_session

    return local_session(8, memory="6g", app="tests")


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
