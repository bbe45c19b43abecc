import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from voxmill.session import build_session

    s = build_session("voxmill-tests", cores=4)
    s.sparkContext.setLogLevel("ERROR")
    s.conf.set("spark.sql.shuffle.partitions", "4")
    return s


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
