import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
DATA = Path(os.environ.get("GRAINMILL_TESTDATA", "/root/testdata"))


@pytest.fixture(scope="session")
def spark():
    from grainmill.runtime import local_session

    session = local_session(4, "tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tiny():
    return str(DATA / "sf0.001")


@pytest.fixture(scope="session")
def small():
    return str(DATA / "sf0.01")
