import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from sensorbay.plans import catalog, jobs
from sensorbay.sources import tables as T
from tests.conftest import SF_SMALL


def test_entry_and_registry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
    assert {"logistic_forecast"} <= set(E.queries()) - set(E.oracle_sql())


def test_stream_equals_batch(spark):
    stream = catalog.QUERIES["stream_ingest"](spark, SF_SMALL)
    batch = catalog.QUERIES["payload_route"](spark, SF_SMALL).drop("msg_id")
    cols = sorted(batch.columns)
    assert sorted(map(repr, stream.select(cols).collect())) == sorted(map(repr, batch.select(cols).collect()))


@pytest.mark.parametrize("query, module, start", [("stream_ingest", "IG", "start_ingest"), ("stream_hourly_mean", "SH", "start_hourly_stream")])
def test_stream_source_grows_with_its_rows(spark, monkeypatch, query, module, start):
    """The files of a source, and of a micro-batch, follow the rows; a micro-batch never has more than the bound."""
    seen, begin = {}, getattr(getattr(catalog, module), start)

    def spy(spark, source, *args, max_files_per_trigger):
        seen.update(files=len([f for f in os.listdir(source) if f.endswith(".parquet")]), per=max_files_per_trigger)
        return begin(spark, source, *args, max_files_per_trigger=max_files_per_trigger)

    monkeypatch.setattr(getattr(catalog, module), start, spy)
    monkeypatch.setattr(catalog, "SOURCE_ROWS", 50, raising=False)
    monkeypatch.setattr(catalog, "BATCH_FILES", 8, raising=False)
    n = T.load(spark, SF_SMALL, "events").where("ts IS NOT NULL").count()
    out = catalog.QUERIES[query](spark, SF_SMALL)
    assert seen == {"files": -(-n // 50), "per": min(-(-seen["files"] // 4), 8)}
    batch = catalog.QUERIES["payload_route" if query == "stream_ingest" else "hourly_mean"](spark, SF_SMALL)
    assert out.count() == batch.count()


def test_run_batch_end_to_end(spark, tmpdir_path):
    ev = T.load(spark, SF_SMALL, "events")
    raw = T.readings_from_events(ev, "type")
    raw_path = f"{tmpdir_path}/raw"
    raw.withColumn("date", F.to_date("ts")).write.partitionBy("date").parquet(raw_path)
    jobs.clean_cycle(spark, raw_path, f"{tmpdir_path}/clean", now="2024-01-31T00:00:00", lookback="35d")
    # a second cycle over a shorter lookback upserts the same keys: row count unchanged
    jobs.clean_cycle(spark, raw_path, f"{tmpdir_path}/clean", now="2024-01-31T00:00:00", lookback="5d")
    assert spark.read.parquet(f"{tmpdir_path}/clean").count() == ev.count()
    fc = jobs.forecast_cycle(spark, f"{tmpdir_path}/clean", f"{tmpdir_path}/fc", now="2024-01-31T00:00:00",
                             model="profile", min_hours=48)
    assert spark.read.parquet(f"{tmpdir_path}/fc").count() == fc.count() > 0
    s = jobs.accuracy_test(spark, f"{tmpdir_path}/clean", "2024-01-23", 7, f"{tmpdir_path}/acc",
                           f"{tmpdir_path}/det", now="2024-01-31T00:00:00", model="profile")
    assert s.count() > 0 and os.path.isdir(f"{tmpdir_path}/det")
    d = jobs.decomposition(spark, f"{tmpdir_path}/clean", f"{tmpdir_path}/dec", start="2024-01-01",
                           end="2024-01-29", method="classical")
    assert d.count() > 0


def test_stream_hourly_equals_batch(spark):
    s = catalog.QUERIES["stream_hourly_mean"](spark, SF_SMALL)
    b = catalog.QUERIES["hourly_mean"](spark, SF_SMALL)
    cols = ["sensor_id", "ds", "y", "n"]
    assert sorted(map(repr, s.select(cols).collect())) == sorted(map(repr, b.select(cols).collect()))


@pytest.mark.parametrize("files,per_trigger", [(1, 1), (6, 2), (20, 3)])
def test_stream_hourly_is_independent_of_files_and_order(spark, tmpdir_path, files, per_trigger):
    from sensorbay.streaming import hourly as SH
    r = T.readings_from_events(T.load(spark, SF_SMALL, "events"), "type").withColumn("v", F.col("people"))
    r.repartition(files, F.rand(5)).write.parquet(f"{tmpdir_path}/src")
    SH.start_hourly_stream(spark, f"{tmpdir_path}/src", f"{tmpdir_path}/h", f"{tmpdir_path}/ck",
                           max_files_per_trigger=per_trigger).awaitTermination()
    got = {(x.sensor_id, x.ds): (round(x.y, 6), x.n) for x in SH.read_hourly(spark, f"{tmpdir_path}/h").collect()}
    from sensorbay.operators.resample import hourly_mean
    want = {(x.sensor_id, x.ds): (round(x.y, 6), x.k) for x in hourly_mean(r, "v", count="k").collect()}
    assert got == want and sum(n for _, n in got.values()) == r.where("v IS NOT NULL").count()


def test_backup_roundtrip(spark):
    back = catalog.QUERIES["backup_roundtrip"](spark, SF_SMALL)
    log = catalog.QUERIES["device_log"](spark, SF_SMALL).drop("msg_id")
    cols = ["device", "timestamp", "topic", "payload"]
    assert sorted(map(repr, back.select(cols).collect())) == sorted(map(repr, log.select(cols).collect()))


def test_ingest_restart_is_idempotent(spark, tmpdir_path):
    from sensorbay.sources.messages import messages_from_events
    from sensorbay.streaming import ingest as IG
    src, out, ck = f"{tmpdir_path}/src", f"{tmpdir_path}/out", f"{tmpdir_path}/ck"
    messages_from_events(T.load(spark, SF_SMALL, "events")).repartition(2).write.parquet(src)
    IG.start_ingest(spark, src, out, ck, max_files_per_trigger=1).awaitTermination()
    first = sorted(map(repr, spark.read.parquet(f"{out}/raw").collect()))
    # a restart on the same checkpoint finds nothing new and leaves the output as it was
    IG.start_ingest(spark, src, out, ck, max_files_per_trigger=1).awaitTermination()
    assert sorted(map(repr, spark.read.parquet(f"{out}/raw").collect())) == first
    # replaying a run's micro-batch replaces its own folder with the same rows
    for _ in range(2):
        IG.write_batch(spark.read.parquet(src), out, 7, "replayed")
        assert spark.read.parquet(f"{out}/raw").count() == 2 * len(first)
    # a second query with a checkpoint of its own adds its rows and destroys none
    few = f"{tmpdir_path}/few"
    spark.read.parquet(src).where("msg_id % 3 = 0").repartition(1).write.parquet(few)
    IG.start_ingest(spark, few, out, f"{tmpdir_path}/ck2", max_files_per_trigger=1).awaitTermination()
    assert len(set(map(repr, spark.read.parquet(f"{out}/raw").select("sensor_id", "ts", "msg_id").collect()))) == len(first)
    assert spark.read.parquet(f"{out}/raw").count() > 2 * len(first)
    with pytest.raises(ValueError):
        IG.write_batch(spark.read.parquet(src).drop("arrival_ts"), out)


def test_read_unquoted_backup(spark, tmpdir_path):
    import pathlib
    d = pathlib.Path(tmpdir_path) / "logs"
    d.mkdir()
    (d / "robo.csv").write_text("timestamp,topic,payload\n"
                                '2026-02-16T14:50:00.123456+00:00,sensors/robo,{"id":"robo","people":5,"x":1}\n')
    rows = T.read_backup(spark, str(d), quoted=False).collect()
    assert [(r.device, r.topic, r.payload) for r in rows] == [
        ("robo", "sensors/robo", '{"id":"robo","people":5,"x":1}')]


def test_batch_stops_when_cleaning_fails(spark, tmpdir_path):
    import pytest
    with pytest.raises(Exception):
        jobs.run_batch(spark, f"{tmpdir_path}/no_such_raw", f"{tmpdir_path}/clean", f"{tmpdir_path}/fc",
                       now="2024-01-31T00:00:00", model="profile")
    assert not os.path.exists(f"{tmpdir_path}/fc")
