import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(__file__)))
DATA = os.environ.get("LEAFMILL_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from leafmill.session import session

    own = session("local[4]", spark__sql__shuffle__partitions="4", spark__driver__memory="4g")
    own.sparkContext.setLogLevel("ERROR")
    yield own
    own.stop()


@pytest.fixture(scope="session")
def data():
    if not os.path.isdir(DATA):
        pytest.skip("no test data")
    return DATA
