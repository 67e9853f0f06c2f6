import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from scorewell.session import get_session
    s = get_session(master="local[8]", shuffle_partitions=8,
                    extra={"spark.driver.memory": "8g"})
    # small buckets so the multi-bucket running-sum path runs in every test
    s.conf.set("scorewell.rowsPerBucket", "700")
    yield s
    s.stop()
