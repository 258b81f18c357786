from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from lapseflow.session import local_session  # noqa: E402


# Column expressions need a session, and test modules build some while they load.
SESSION = local_session(**{"spark__sql__shuffle__partitions": "4"})


@pytest.fixture(scope="session")
def spark():
    yield SESSION
    SESSION.stop()


@pytest.fixture(scope="session")
def folder() -> str:
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
