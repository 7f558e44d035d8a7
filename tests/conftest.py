import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakemeter.session import build_session, checkpoint_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app_name="lakemeter-tests", shuffle_partitions=4,
                      extra={"spark.default.parallelism": "4"})
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="lakemeter-test-")
