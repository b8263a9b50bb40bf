import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from marketlens.session import get_session
    s = get_session("local[4]", 4, app_name="marketlens-tests",
                    extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="ml-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def tables_small(spark):
    from marketlens.sources.tables import Tables
    return Tables(spark, SF_SMALL)
