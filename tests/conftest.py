import os
import sys
import tempfile
from datetime import datetime

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from warnindex.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"

MSG_SCHEMA = "fwdCode string, timeRaised timestamp_ntz, severity string, severityLevel int, isTidal boolean, msg_id bigint"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", shuffle_partitions=4, app="warnindex-tests",
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="warnindex-test-ckpt-")})
    yield s
    s.stop()


def ts(s: str) -> datetime:
    return datetime.fromisoformat(s)


@pytest.fixture
def msgs(spark):
    """Build a message frame from (code, time, severity text, level, isTidal) tuples."""

    def make(rows, schema=MSG_SCHEMA):
        out = []
        for i, r in enumerate(rows):
            code, t, sev, lvl = r[0], r[1], r[2], r[3]
            tidal = r[4] if len(r) > 4 else False
            out.append((code, ts(t) if isinstance(t, str) else t, sev, lvl, tidal, i))
        return spark.createDataFrame(out, schema)

    return make
