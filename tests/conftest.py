import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from rivet.session import get_session
    s = get_session("local[4]", app="rivet-tests", shuffle_partitions=4,
                    extra={"spark.driver.memory": "6g",
                           "spark.checkpoint.dir": tempfile.mkdtemp(prefix="rivet-test-ckpt-")})
    yield s
