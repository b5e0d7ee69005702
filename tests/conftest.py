from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ratelake.session import build_session

    s = build_session("local[*]", app_name="ratelake-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def tmp_shared(spark):
    """A fresh folder under the session's shared checkpoint folder."""
    from ratelake.session import shared_path

    return shared_path(spark, "test")
