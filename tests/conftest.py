import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sensorbay.session import get_spark  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[4]", 4, extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="sb-test-ckpt-")})
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="sb-test-")


def hourly(start="2024-01-01T00:00:00", n=10, step_minutes=60):
    t0 = dt.datetime.fromisoformat(start)
    return [t0 + dt.timedelta(minutes=step_minutes * i) for i in range(n)]


def readings(spark, series: dict):
    """``{sensor: [(ts, value), ...]}`` -> readings frame ``sensor_id, ts, seq, people``."""
    rows = []
    for sid, pts in series.items():
        for i, (ts, v) in enumerate(pts):
            rows.append((sid, ts, i, None if v is None else float(v)))
    return spark.createDataFrame(rows, "sensor_id string, ts timestamp_ntz, seq long, people double")
