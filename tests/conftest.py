import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from reportflow.session import checkpoint_dir, get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", app_name="reportflow-tests", shuffle_partitions=4)
    checkpoint_dir(s, tempfile.mkdtemp(prefix="reportflow-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_out(tmp_path):
    return str(tmp_path)
