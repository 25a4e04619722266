import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

@pytest.fixture(scope="session")
def spark():
    from tianguis.session import local_session

    return local_session(4, **{"spark.sql.shuffle.partitions": "4"})
