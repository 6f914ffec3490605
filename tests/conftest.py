import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from vachan.session import get_spark

    os.environ.setdefault("VACHAN_DRIVER_MEMORY", "8g")
    s = get_spark("vachan-tests", "local[4]", 4)
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="vachan-test-")
