import datetime as dt

import pytest

from sensorbay.plans import catalog
from sensorbay.sources.tables import Interval, job_interval, parse_duration, scan_lookback, scan_range


def test_parse_duration():
    assert parse_duration("24h") == dt.timedelta(hours=24)
    assert parse_duration("35d") == dt.timedelta(days=35)
    with pytest.raises(ValueError):
        parse_duration("soon")


def test_job_interval():
    now = dt.datetime(2024, 1, 31, 12)
    assert job_interval(now, days=7) == (dt.datetime(2024, 1, 24, 12), now)
    # dates: the last day is included, the range is half-open
    assert job_interval(now, None, "2024-01-01", "2024-01-30") == (dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 31))
    # days=0 counts as absent
    assert job_interval(now, 0, "2024-01-01", "2024-01-01") == Interval(dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2))
    with pytest.raises(ValueError):
        job_interval(now, days=0)


def test_scans_are_half_open_and_prune_date_partitions(spark, tmpdir_path):
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=6 * i)) for i in range(40)]
    df = spark.createDataFrame(rows, "seq long, ts timestamp_ntz")
    df.selectExpr("*", "to_date(ts) AS date").write.partitionBy("date").parquet(f"{tmpdir_path}/t")
    t = spark.read.parquet(f"{tmpdir_path}/t")
    for got, lo, hi in ((scan_range(t, "2024-01-02T00:00:00", "2024-01-03T00:00:00"), 4, 8),
                        (scan_lookback(t, "2024-01-05T06:00:00", "24h"), 13, 17), (scan_range(t, stop="2024-01-01T06:00:00"), 0, 1)):
        assert sorted(r.seq for r in got.collect()) == list(range(lo, hi))
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(date" in plan, plan


def test_lookback_query_reads_its_35_days(spark, tmpdir_path):
    """The window is ``[2023-12-27, 2024-01-31)``: both ends cut, nothing between them does."""
    first, stop = dt.datetime(2023, 12, 27), dt.datetime(2024, 1, 31)
    times = [first - dt.timedelta(microseconds=1), *(first + dt.timedelta(hours=7 * i) for i in range(120)),
             stop - dt.timedelta(microseconds=1), stop, stop + dt.timedelta(days=3), None]
    rows = [(i, t, i % 5, "view", float(i), "{}") for i, t in enumerate(times)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string") \
        .write.parquet(f"{tmpdir_path}/events.parquet")
    got = catalog.QUERIES["lookback_scan"](spark, tmpdir_path)
    assert sorted(r.seq for r in got.collect()) == list(range(1, 122))
