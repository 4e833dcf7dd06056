import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from marksman.plans.sizing import checkpoint_dir
    from marksman.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="marksman-tests")
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s)  # tests may set their own when the session has none
    yield s
    s.stop()
