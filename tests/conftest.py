from __future__ import annotations

import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from adspend.session import local_session  # noqa: E402
from support import Inputs  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8, app="adspend-tests")
    yield s


@pytest.fixture
def make(spark):
    return lambda: Inputs(spark)
