import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewater.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    s = local_session(cores="*", shuffle_partitions=8, extra={"spark.checkpoint.dir": shared})
    yield s


@pytest.fixture()
def scratch(spark):
    from tidewater.session import scratch_path
    return scratch_path(spark, "test")
