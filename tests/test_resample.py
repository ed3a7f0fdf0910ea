import datetime as dt

from sensorbay.operators import resample as RS
from tests.conftest import readings


def test_hourly_mean_stop_labels(spark):
    t0 = dt.datetime(2024, 1, 1, 10, 0)
    pts = [(t0, 1), (t0 + dt.timedelta(minutes=30), 3), (t0 + dt.timedelta(hours=2, minutes=5), 10),
           (t0 + dt.timedelta(hours=3, minutes=40), 7)]
    df = readings(spark, {"a": pts})
    out = sorted((r.ds, r.y) for r in RS.hourly_mean(df).collect())
    assert out == [(dt.datetime(2024, 1, 1, 11), 2.0), (dt.datetime(2024, 1, 1, 13), 10.0),
                   (dt.datetime(2024, 1, 1, 14), 7.0)]
    stop = dt.datetime(2024, 1, 1, 13, 50)
    keep = sorted(r.ds for r in RS.hourly_mean(df, stop=stop, partial_last="keep").collect())
    drop = sorted(r.ds for r in RS.hourly_mean(df, stop=stop, partial_last="drop").collect())
    assert keep[-1] == stop and drop[-1] == dt.datetime(2024, 1, 1, 13)


def test_grid_and_fill(spark):
    h = spark.createDataFrame([("a", dt.datetime(2024, 1, 1, 1), 1.0), ("a", dt.datetime(2024, 1, 1, 4), 4.0),
                               ("a", dt.datetime(2024, 1, 1, 4, 30), 9.0)], "sensor_id string, ds timestamp_ntz, y double")
    g = RS.fill_series(RS.hourly_grid(h.where("minute(ds) = 0")), "y", "yf")
    out = [(r.ds.hour, r.y, r.yf) for r in g.orderBy("ds").collect()]
    assert out == [(1, 1.0, 1.0), (2, None, 1.0), (3, None, 1.0), (4, 4.0, 4.0)]


def test_grid_drops_off_grid_label(spark):
    t0 = dt.datetime(2024, 1, 1, 10, 0)
    pts = [(t0 + dt.timedelta(minutes=m), 1) for m in (0, 70, 130, 200)]
    df = readings(spark, {"a": pts})
    h = RS.hourly_mean(df, stop=dt.datetime(2024, 1, 1, 13, 30), partial_last="keep")
    labels = sorted(r.ds for r in h.collect())
    assert labels[-1] == dt.datetime(2024, 1, 1, 13, 30)
    grid = sorted(r.ds for r in RS.hourly_grid(h).collect())
    assert grid == [dt.datetime(2024, 1, 1, 11), dt.datetime(2024, 1, 1, 12), dt.datetime(2024, 1, 1, 13)]
