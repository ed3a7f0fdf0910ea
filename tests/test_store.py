import datetime as dt

import pytest
from pyspark.sql import functions as F

from sensorbay.sinks import store as ST

SCHEMA = "sensor_id string, ts timestamp_ntz, people long, temperature double"


def _t(h):
    return dt.datetime(2024, 1, 1, h)


def test_upsert_field_level_and_idempotent(spark):
    old = spark.createDataFrame([("a", _t(1), 1, 20.0), ("a", _t(2), 2, 21.0)], SCHEMA)
    new = spark.createDataFrame([("a", _t(2), 5, None), ("a", _t(3), 6, 22.0)], SCHEMA)
    once = ST.upsert_latest(old, new, ["sensor_id", "ts"])
    twice = ST.upsert_latest(once, new, ["sensor_id", "ts"])
    rows = sorted(tuple(r) for r in once.select("sensor_id", "ts", "people", "temperature").collect())
    assert rows == [("a", _t(1), 1, 20.0), ("a", _t(2), 5, 21.0), ("a", _t(3), 6, 22.0)]
    assert sorted(map(tuple, twice.select(*once.columns).collect())) == sorted(map(tuple, once.collect()))


def test_delete_predicates(spark):
    df = spark.createDataFrame([("a", _t(1), 1, 1.0), ("b", _t(2), 2, 2.0), ("", _t(3), 3, 3.0)], SCHEMA)
    keep = lambda **kw: sorted(r.people for r in ST.delete_where(df, **kw).collect())
    assert keep(start=_t(0), end=_t(2), tag_key="sensor_id", tag_value="a") == [2, 3]
    assert keep(start=_t(0), end=_t(3), tag_key="sensor_id") == [3]        # present and not empty
    assert keep(start=_t(0), end=_t(3), tag_value="a") == [3]              # value without key ignored
    assert keep(start=_t(0), end=_t(5), tag_key="nope") == [1, 2, 3]      # unknown tag matches nothing
    assert keep(end=_t(2)) == [2, 3]                                       # default start


def test_table_upsert_and_delete(spark, tmpdir_path):
    path = f"{tmpdir_path}/clean"
    a = spark.createDataFrame([("a", _t(1), 1, 20.0), ("a", dt.datetime(2024, 1, 2, 1), 2, 21.0)], SCHEMA)
    ST.upsert_table(spark, a, path, ["sensor_id", "ts"])
    b = spark.createDataFrame([("a", _t(1), 7, None)], SCHEMA)
    ST.upsert_table(spark, b, path, ["sensor_id", "ts"])
    ST.upsert_table(spark, b, path, ["sensor_id", "ts"])
    got = sorted((r.ts, r.people, r.temperature) for r in spark.read.parquet(path).collect())
    assert got == [(_t(1), 7, 20.0), (dt.datetime(2024, 1, 2, 1), 2, 21.0)]
    with pytest.raises(PermissionError):
        ST.delete_table(spark, path, start=_t(0), end=_t(5))
    n = ST.delete_table(spark, path, confirm=True, start=_t(0), end=_t(5))
    assert n == 1
    assert [r.people for r in spark.read.parquet(path).collect()] == [2]


def test_first_write_merges_like_later_ones(spark, tmpdir_path):
    rows = [("a", _t(1), 1, 20.0), ("a", _t(1), 3, None), ("a", _t(2), 2, 21.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = [(_t(1), 3, 20.0), (_t(2), 2, 21.0)]
    for _ in range(2):  # first write, then a merge of the same rows
        ST.upsert_table(spark, df, f"{tmpdir_path}/t", ["sensor_id", "ts"])
        assert sorted((r.ts, r.people, r.temperature) for r in spark.read.parquet(f"{tmpdir_path}/t").collect()) == want


def test_version_decides_and_is_kept(spark, tmpdir_path):
    schema = SCHEMA + ", ver long"
    write = lambda *rows: ST.upsert_table(spark, spark.createDataFrame(list(rows), schema), f"{tmpdir_path}/v",
                                          ["sensor_id", "ts"], version="ver")
    write(("a", _t(1), 5, 1.0, 7), ("a", _t(1), 4, 2.0, 9))
    write(("a", _t(1), 6, 3.0, 8))  # arrives late: older than what is stored
    assert [(r.people, r.temperature, r.ver) for r in spark.read.parquet(f"{tmpdir_path}/v").collect()] == [(4, 2.0, 9)]
    write(("a", _t(1), None, 3.0, 10))
    assert [(r.people, r.temperature, r.ver) for r in spark.read.parquet(f"{tmpdir_path}/v").collect()] == [(4, 3.0, 10)]


def test_delete_from_all_tables(spark, tmpdir_path):
    paths = {n: f"{tmpdir_path}/{n}" for n in ("raw", "clean")}
    for p in paths.values():
        ST.append(spark, spark.createDataFrame([("a", _t(1), 1, 1.0), ("b", _t(2), 2, 2.0)], SCHEMA), p)
    with pytest.raises(PermissionError):
        ST.delete_tables(spark, paths)
    assert ST.delete_tables(spark, paths, confirm=True, tag_key="sensor_id", tag_value="a") == {"raw": 1, "clean": 1}
    assert ST.delete_tables(spark, paths, confirm=True, table="raw") == {"raw": 1}
    assert spark.read.parquet(paths["clean"]).count() == 1


def _files(path):
    import glob
    return {d.rsplit("date=", 1)[1]: len(glob.glob(f"{d}/*.parquet")) for d in glob.glob(f"{path}/date=*")}


def test_a_day_is_written_by_as_many_tasks_as_its_rows_need(spark, tmpdir_path):
    path = f"{tmpdir_path}/sized"
    big = spark.range(10_000).selectExpr("concat('s', id % 3) AS sensor_id", "CAST(TIMESTAMP'2024-01-01' + make_dt_interval(0, 0, 0, id) AS TIMESTAMP_NTZ) AS ts",
                                         "id AS people", "CAST(NULL AS DOUBLE) AS temperature")
    small = spark.createDataFrame([("a", dt.datetime(2024, 1, 2, 1), 2, 21.0)], SCHEMA)
    ST.upsert_table(spark, big.unionByName(small), path, ["sensor_id", "ts"], file_rows=1_000)
    assert _files(path) == {"2024-01-01": 10, "2024-01-02": 1}
    # again over what is stored: rows stay, the day's bound counts old and new
    ST.upsert_table(spark, big.where("id < 500"), path, ["sensor_id", "ts"], file_rows=1_000)
    got = spark.read.parquet(path)
    assert got.count() == 10_001 and _files(path)["2024-01-01"] == 11
    assert got.where("date = '2024-01-01'").exceptAll(big.withColumn("date", F.to_date("ts"))).count() == 0
    assert ST.delete_table(spark, path, confirm=True, file_rows=1_000, start="2024-01-01T00:00:00", end="2024-01-01T02:00:00") == 7_200
    assert _files(path) == {"2024-01-01": 3, "2024-01-02": 1}


def _batch(spark, out, run, batch, rows):
    """As ingest lays it out: by date below the batch."""
    (spark.createDataFrame(rows, SCHEMA).withColumn("date", F.to_date("ts")).write.mode("overwrite").partitionBy("date")
     .parquet(f"{out}/run={run}/batch={batch}"))


def test_compaction_keeps_every_row_once(spark, tmpdir_path, monkeypatch):
    from sensorbay.sinks import compact as CP
    out = f"{tmpdir_path}/raw"
    rows = lambda: sorted(map(repr, CP.read_raw(spark, out).collect()))
    for b in range(6):
        _batch(spark, out, "r1", b, [("a", _t(b), b, 1.0), ("b", dt.datetime(2024, 1, 2 + b % 2, b), b, None)])
    _batch(spark, out, "r2", 0, [("c", _t(3), 9, 1.0)])
    before = rows()
    assert len(before) == 13 and CP.open_raw(spark, out).count() == 13
    # stopped after the new leaves were written: nothing changes, the next run clears them
    with monkeypatch.context() as m:
        m.setattr(CP, "_commit", lambda *a: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError):
            CP.compact(spark, out)
    assert rows() == before
    # stopped after the manifest was put in place: the new leaves count
    with monkeypatch.context() as m:
        calls = []
        real = CP._finish
        m.setattr(CP, "_finish", lambda *a: real(*a) if not calls.append(1) and len(calls) == 1 else (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError):
            CP.compact(spark, out)
    assert rows() == before
    assert CP.compact(spark, out) == 0 and rows() == before
    left = CP.current_leaves(spark, out)
    assert sorted(leaf.run for leaf in left if not leaf.run.startswith(CP.COMPACT)) == ["r1", "r1", "r2"]  # the last batches
    # later batches join the day's compacted leaf
    for b in range(6, 9):
        _batch(spark, out, "r1", b, [("a", _t(b), b, 1.0)])
    before = rows()
    CP.compact(spark, out)
    assert rows() == before
    per_day = [leaf.date for leaf in CP.current_leaves(spark, out) if leaf.run.startswith(CP.COMPACT)]
    assert len(per_day) == len(set(per_day)) == 3


def test_device_log_files_follow_tasks_not_devices(spark, tmpdir_path):
    import glob

    from sensorbay.sources import tables as T
    from sensorbay.streaming import ingest as IG
    log = spark.range(3_000).selectExpr("concat('dev', id % 1000, ',\"x') AS device", "CAST(id AS STRING) AS timestamp", "'t' AS topic",
                                        "concat('{\"a\": ', id, ', \"b\": \"q\"}') AS payload")
    IG.write_device_log(log, f"{tmpdir_path}/log")
    assert len(glob.glob(f"{tmpdir_path}/log/*/*.csv")) <= T.DEVICE_BUCKETS
    back = T.read_backup(spark, f"{tmpdir_path}/log")
    assert back.exceptAll(log).count() == 0 and back.count() == 3_000
    one = T.read_backup(spark, f"{tmpdir_path}/log", device='dev7,"x')
    assert one.count() == 3 and "PartitionFilters: [isnotnull(bucket" in one._jdf.queryExecution().executedPlan().toString()


def test_cleaning_account_and_halo(spark, tmpdir_path):
    """Hourly cycles that read a halo give what one clean of the whole history gives, and tell every sensor's state."""
    from sensorbay.operators import clean as CL
    from sensorbay.plans import jobs as JB
    t0 = dt.datetime(2024, 1, 1)
    rows = [("aiot", t0 + dt.timedelta(minutes=10 * i), i, None if i % 9 == 4 else float((i * 7) % 13 + (40 if i % 23 == 0 else 0))) for i in range(200)]
    rows += [("robo", t0 + dt.timedelta(minutes=10 * i), i, None) for i in range(200)] + [("robo", None, 1, 4.0)]
    raw = spark.createDataFrame(rows, "sensor_id string, ts timestamp_ntz, seq long, people double")
    raw.withColumn("date", F.to_date("ts")).write.partitionBy("date").parquet(f"{tmpdir_path}/raw")
    whole = {(r.sensor_id, r.ts): r.people for r in CL.clean(raw).collect()}
    end = t0 + dt.timedelta(hours=30)
    for h in (28, 29, 30):
        JB.clean_cycle(spark, f"{tmpdir_path}/raw", f"{tmpdir_path}/clean", now=t0 + dt.timedelta(hours=h), lookback="2h", halo="12h",
                       status_path=f"{tmpdir_path}/status")
    got = {(r.sensor_id, r.ts): r.people for r in spark.read.parquet(f"{tmpdir_path}/clean").collect()}
    assert min(ts for _, ts in got) == t0 + dt.timedelta(hours=26)
    settled = end - dt.timedelta(hours=1)   # rows with neighbours on both sides
    assert {k: v for k, v in got.items() if k[1] < settled} == {k: v for k, v in whole.items() if k in got and k[1] < settled}
    last = spark.read.parquet(f"{tmpdir_path}/status").where(F.col("ts") == F.lit(end).cast("timestamp_ntz")).collect()
    assert {(r.sensor_id, r.n_rows, r.n_untimed, r.status) for r in last} == {
        ("aiot", 12, 0, "ok"), ("robo", 12, 1, "no_values"), ("simulated", 0, 0, "no_rows")}


def test_each_sensor_is_fitted_once_per_run(spark, tmpdir_path, monkeypatch):
    from sensorbay.plans import jobs as JB
    t0 = dt.datetime(2024, 1, 1)
    rows = [(s, t0 + dt.timedelta(hours=i), 10 + i % 24) for s in ("a", "b") for i in range(24 * 9)] + [("c", t0, 1)]
    ST.upsert_table(spark, spark.createDataFrame(rows, "sensor_id string, ts timestamp_ntz, people long"), f"{tmpdir_path}/clean", ["sensor_id", "ts"])
    runs, real = spark.sparkContext.accumulator(0), JB.FC.logistic_forecast

    def counted(*a, **kw):
        def count(batches):
            for b in batches:
                runs.add(b.num_rows)
                yield b
        fc = real(*a, **kw)
        return fc.mapInArrow(count, fc.schema)

    monkeypatch.setattr(JB.FC, "logistic_forecast", counted)
    JB.forecast_cycle(spark, f"{tmpdir_path}/clean", f"{tmpdir_path}/fc", now=t0 + dt.timedelta(days=9), periods=10,
                      status_path=f"{tmpdir_path}/status").collect()
    assert runs.value == 2 * 10
    assert spark.read.parquet(f"{tmpdir_path}/fc").count() == 20
    assert {(r.sensor_id, r.status) for r in spark.read.parquet(f"{tmpdir_path}/status").collect()} == {("a", "ok"), ("b", "ok"), ("c", "too_short")}
