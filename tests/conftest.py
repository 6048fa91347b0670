from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
# Python workers must find the package too (stateful operators run in them).
os.environ["PYTHONPATH"] = os.pathsep.join(
    [str(ROOT), *filter(None, [os.environ.get("PYTHONPATH")])]
)

from fleetlens.operators.ordered import Limits  # noqa: E402
from fleetlens.session import local_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, name="fleetlens-tests", memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return DATA


@pytest.fixture(scope="session")
def tiny():
    """Limits that make almost every key hot, so that the cut path runs."""
    return Limits(max_rows=15, min_rows=10, max_cuts=10_000)
