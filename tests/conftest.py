from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from ledgerstar.session import build_session, checkpoint_location

    s = build_session("local[*]", app="ledgerstar-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    if not checkpoint_location(s):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerstar-tests-"))
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    """A fresh folder under the session's checkpoint location."""
    from ledgerstar.session import checkpoint_location

    return tempfile.mkdtemp(prefix="case-", dir=checkpoint_location(spark).replace("file:", ""))
