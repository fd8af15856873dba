from __future__ import annotations

import os

import pytest


@pytest.fixture(scope="session")
def sf_dir():
    return f"{os.environ.get('TESTDATA_DIR', '/root/testdata')}/sf0.001"
