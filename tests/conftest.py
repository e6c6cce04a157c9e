import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from weftlink.session import local_session

    s = local_session(4, "4g")
    s.sparkContext.setLogLevel("ERROR")
    s.conf.set("spark.sql.shuffle.partitions", "2")
    s.conf.set("spark.sql.codegen.wholeStage", "false")  # tiny tables: compiling would take longer than running
    return s
