"""Payload cases of FIXTURES.md section 1.1."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sensorbay.functions import payload as P
from sensorbay.streaming import ingest as IG

CASES = [
    # payload, expected raw row (sensor, valid, people, T, H, CO2) or None, device
    ('{"id":"robo","person count":7}', ("robo", True, 7, None, None, None), "robo"),
    ('{"id":"aiot","people":"12.9"}', ("aiot", True, 12, None, None, None), "aiot"),
    ('{"id":"aiot","count":99}', ("aiot", False, 99, None, None, None), "aiot"),
    ('{"id":"robo","pCount":-3}', ("robo", False, -3, None, None, None), "robo"),
    ('{"id":"robo","person_count":"x","people":4}', ("robo", True, 4, None, None, None), "robo"),
    ('{"id":"robo","T":20}', None, "robo"),
    ('{"id":"zz","people":55}', ("zz", False, 55, None, None, None), "zz"),
    ('{"people":5}', ("unknown", True, 5, None, None, None), "unknown"),
    ('{"id":"simulated","T":21.5,"H":40,"CO2":"650.7","pCount":12}', ("simulated", True, 12, 21.5, 40.0, 650), "simulated"),
    ('{"id":"simulated","T":-30,"H":100,"CO2":5000}', ("simulated", True, None, -30.0, 100.0, 5000), "simulated"),
    ('{"id":"simulated","T":61}', None, "simulated"),
    ('{"id":"simulated","T":20,"person_count":3}', ("simulated", True, None, 20.0, None, None), "simulated"),
    ('{"id":"simulated","pCount":null,"people":3}', None, "simulated"),
    ('{"id":"simulated"}', None, "simulated"),
    ('{"id":"robo","people":5', None, None),
    ("[1,2]", None, None),
    ('{"id":"a/b c","people":1}', ("a/b c", True, 1, None, None, None), "abc"),
    ('{"id":"","people":1}', ("", True, 1, None, None, None), "unknown_device"),
]


@pytest.fixture(scope="module")
def msgs(spark):
    t = dt.datetime(2026, 2, 16, 14, 50, 0, 123456)
    rows = [(i, "sensors/x", p, t) for i, (p, _, _) in enumerate(CASES)]
    return spark.createDataFrame(rows, "msg_id long, topic string, payload string, arrival_ts timestamp")


def test_raw_points(msgs):
    got = {r.msg_id: r for r in IG.raw_points(msgs, keep_id=True).collect()}
    for i, (payload, exp, _) in enumerate(CASES):
        if exp is None:
            assert i not in got, payload
            continue
        r = got[i]
        assert (r.sensor_id, r.valid, r.people, r.temperature, r.humidity, r.co2) == exp, payload


def test_device_log_and_dead_letters(msgs):
    log = {r.msg_id: r for r in IG.device_log(msgs, keep_id=True).collect()}
    dead = {r.msg_id: r.reason for r in IG.dead_letters(msgs, keep_id=True).collect()}
    for i, (payload, _, dev) in enumerate(CASES):
        if dev is None:
            assert i not in log and dead[i] == "not_json_object"
        else:
            assert log[i].device == dev and i not in dead
            assert log[i].timestamp == "2026-02-16T14:50:00.123456+00:00"


def test_regex_fallback_and_mixed(spark):
    df = spark.createDataFrame([('{"id":"robo","people":5',), ('xx "PCOUNT" : 17 yy',), ("[1,2]",),
                                ('{"id":"robo","T":1}',), ('{"id":"r","count":"3.0"}',), ("no digits",)], "p string")
    got = [r[0] for r in df.select(P.extract_count("p")).collect()]
    # malformed -> regex; case-insensitive; array -> regex finds nothing; object without key -> no
    # regex retry; float text in the last key; nothing
    assert got == [5, 17, None, None, 3, None]


def test_conversions(spark):
    df = spark.createDataFrame([("12.9",), ("-12.9",), ("1.0d",), ("NaN",), ("true",), (" 7 ",), ("1e2",)], "s string")
    got = [r[0] for r in df.select(P.to_count(F.col("s"))).collect()]
    assert got == [12, -12, None, None, 1, 7, 100]


def test_invalid_utf8(spark):
    df = spark.createDataFrame([(0, "t", bytearray(b'{"id":"robo","people":\xff}'), dt.datetime(2024, 1, 1)),
                                (1, "t", bytearray(b'{"id":"robo","people":3}'), dt.datetime(2024, 1, 1))],
                               "msg_id long, topic string, payload binary, arrival_ts timestamp")
    dead = {r.msg_id: r.reason for r in IG.dead_letters(df, keep_id=True).collect()}
    assert dead == {0: "invalid_utf8"}
    assert [r.people for r in IG.raw_points(df).collect()] == [3]


def test_iso_without_fraction(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 5, 6, 7),)], "t timestamp")
    assert df.select(P.iso_utc("t")).first()[0] == "2024-01-01T05:06:07+00:00"


def test_trailing_whitespace_and_text(spark):
    df = spark.createDataFrame([('{"people":3}\t\n',), ('{"people":3} x',), ("{'people':3}",)], "p string")
    got = [r[0] for r in df.select(P.parse_object("p").isNotNull()).collect()]
    assert got == [True, False, False]


def test_only_one_whole_object_is_an_object(spark):
    from sensorbay.functions import payload as P
    whole = ['{"people":5}', ' {"a":{"x":[1,2]},"b":null}\n', "{}", '{"a":"}"}']
    broken = ['{"people":5} {"people":6}', '{"people":5} x}', '{"people":5},{"people":6}', '{"people":5}}', '{"a":1}],[{"b":2}',
              "{'a':1}", "[1]", "null", '"x"', "", '{"a":1', '{"a":"line\nbreak"}', None]
    df = spark.createDataFrame([(t,) for t in whole + broken], "t string").select("t", P.parse_object("t").alias("m"))
    assert {r.t for r in df.collect() if r.m is not None} == set(whole)


def test_large_capacity_maps_are_joined(spark):
    import datetime as dt

    from sensorbay import config as C
    t = dt.datetime(2024, 1, 1)
    small = {f"s{i}": 10 + i for i in range(C.LITERAL_CONFIG_ROWS)}
    rows = [(i, "t", f'{{"id":"s{i}","people":{9 + i % 3 + i}}}', t) for i in range(C.LITERAL_CONFIG_ROWS + 3)]
    m = spark.createDataFrame(rows, "msg_id long, topic string, payload string, arrival_ts timestamp")
    big = small | {f"other{i}": 1 for i in range(5)}  # one path more, the same answers
    cols = ["msg_id", "sensor_id", "valid", "people"]
    got = [sorted(map(tuple, IG.raw_points(m, c, keep_id=True).select(cols).collect())) for c in (small, big)]
    assert got[0] == got[1] and {r[2] for r in got[0]} == {True, False}
