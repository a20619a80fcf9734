import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from shelfcast.session import build_session

    scratch = tempfile.mkdtemp(prefix="shelfcast-test-")
    s = build_session(
        "local[4]", "shelfcast-tests",
        **{"spark.sql.shuffle.partitions": "4", "spark.sql.warehouse.dir": f"{scratch}/warehouse"},
    )
    s.sparkContext.setLogLevel("OFF")
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="shelfcast-run-")
