import os
import sys
from pathlib import Path

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, [os.environ.get("PYTHONPATH")])])

import pytest  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from veloframe.session import local_session

    s = local_session(cores=4, partitions=4, memory="3g")
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
