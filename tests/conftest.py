import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quarterdeck.plans.storage import checkpoint_root  # noqa: E402
from quarterdeck.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    wh = str(tmp_path_factory.mktemp("warehouse"))
    s = local_session("*", shuffle_partitions=8, app="quarterdeck-tests", extra={"spark.sql.warehouse.dir": wh})
    checkpoint_root(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL
