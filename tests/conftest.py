import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.session import get_spark  # noqa: E402

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_spark("tessera-tests", master="local[4]", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    # a fresh folder per test; scratch data of the library itself goes under
    # spark.checkpoint.dir (set by the environment, or by get_spark if unset)
    return tempfile.mkdtemp(prefix="tessera-test-")
