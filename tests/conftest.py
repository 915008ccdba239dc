import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from riverbed.session import build_session
    s = build_session("local[4]", app="riverbed-tests", shuffle_partitions=8,
                      extra={"spark.driver.memory": "6g",
                             "spark.checkpoint.dir": tempfile.mkdtemp(prefix="riverbed-test-ckpt-")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SMOKE


@pytest.fixture()
def tmp_root():
    return tempfile.mkdtemp(prefix="riverbed-test-")


@pytest.fixture(autouse=True)
def own_sizes(request):
    """Queries leave the session with the sizes of their own kind; the next test starts with its own."""
    yield
    if "spark" in request.fixturenames:
        from riverbed.session import bound_pieces
        bound_pieces(request.getfixturevalue("spark"), False)
