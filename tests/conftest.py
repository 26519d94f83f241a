import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, str(Path(__file__).resolve().parent), os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark():
    from loomline.session import local_session

    s = local_session(8, 8)
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
