from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from vitalwatch.session import build_session, checkpoint_dir

    s = build_session("local[4]", 8, app="vitalwatch-tests",
                      extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="vw-wh-")})
    # tests have no cluster folder: give the session a scratch one
    checkpoint_dir(s, tempfile.mkdtemp(prefix="vw-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="vw-run-")
