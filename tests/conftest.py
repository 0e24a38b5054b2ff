import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from matchday.session import get_spark

    # spark.checkpoint.dir comes from the environment when it names one;
    # matchday.session.checkpoint_dir only creates a private folder if unset
    s = get_spark("local[4]", app_name="matchday-tests", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="matchday-test-")
