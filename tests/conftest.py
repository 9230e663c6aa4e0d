import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from spotlake.session import get_spark

    s = get_spark(8)
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture(scope="session")
def sf():
    return SF
