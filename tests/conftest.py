import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tripwright.session import get_session
    s = get_session("local[*]", app_name="tripwright-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    """A fresh folder under the session's checkpoint folder."""
    import uuid

    from tripwright.session import work_root
    return work_root(spark, "tests", uuid.uuid4().hex)
