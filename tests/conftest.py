import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from sparkcat.session import build

    s = build("local[4]", shuffle_partitions=4, warehouse=str(tmp_path_factory.mktemp("wh")))
    yield s
    s.stop()
