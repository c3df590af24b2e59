import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from windtally import get_spark
    from windtally.session import checkpoint_root

    s = get_spark("local[4]", app="windtally-tests", shuffle_partitions=4)
    checkpoint_root(s)  # unset in tests -> private temp folder
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from windtally.session import scratch_path

    return lambda kind="t": scratch_path(spark, kind)
