import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tidemill.session import get_spark

    # spark.checkpoint.dir is read from the session defaults; tidemill.session sets a
    # local folder only where it is unset
    s = get_spark("local[*]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="tidemill-test-")
