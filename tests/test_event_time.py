import datetime as dt

import pytest
from pyspark.sql import functions as F

from sensorbay.operators import resample as RS
from sensorbay.streaming import event_time as ET

T0 = dt.datetime(2024, 1, 1)


@pytest.mark.parametrize("lateness, some_late", [("30 days", False), ("10 minutes", True)])
def test_event_time_hours(spark, tmpdir_path, lateness, some_late):
    """Ample lateness gives the batch result; a small one, kept and late rows that together are all rows."""
    rows = [("ab"[i % 2], T0 + dt.timedelta(minutes=7 * i), i, float(i % 11), float(i % 11)) for i in range(240)]
    late = [("a", T0 + dt.timedelta(minutes=3), 1_000, 5.0, 5.0), ("c", T0 + dt.timedelta(hours=1), 1_001, 7.0, 7.0), ("a", None, 1_002, 1.0, 1.0)]
    for k, part in enumerate((rows[:80], rows[80:160], late + rows[160:])):
        (spark.createDataFrame(part, "sensor_id string, ts timestamp_ntz, seq long, people double, v double")
         .coalesce(1).write.mode("append").parquet(f"{tmpdir_path}/in"))
    q = ET.start_event_hours(spark, f"{tmpdir_path}/in", f"{tmpdir_path}/hours", f"{tmpdir_path}/late", f"{tmpdir_path}/cp", lateness)
    q.awaitTermination()
    got = {(r.sensor_id, r.ds): (round(r.y, 9), r.n) for r in ET.read_event_hours(spark, f"{tmpdir_path}/hours").collect()}
    lost = spark.read.parquet(f"{tmpdir_path}/late").select("sensor_id", "ts", "seq", "v").collect()
    everything = spark.read.parquet(f"{tmpdir_path}/in").where(F.col("ts").isNotNull())
    assert bool(lost) == some_late
    if some_late:
        assert {1_000, 1_001} <= {r.seq for r in lost}
    kept = everything.where(~F.col("seq").isin([r.seq for r in lost] or [-1]))
    want = {(r.sensor_id, r.ds): (round(r.y, 9), r.n) for r in RS.hourly_mean(kept, "v", count="n").collect()}
    assert got == want
    assert sum(n for _, n in got.values()) + len(lost) == everything.count()
