"""Property test: count extraction against a plain Python reading of the rules."""

import json

from hypothesis import given, settings, strategies as st

from sensorbay.functions import payload as P

KEYS = P.COUNT_KEYS + ["id", "T", "other"]
VALUES = st.one_of(
    st.integers(-100, 300), st.floats(-50, 200, allow_nan=False, allow_infinity=False).map(lambda x: round(x, 2)),
    # the strings "true"/"false" are left out: a map of strings cannot tell them from
    # JSON booleans (accepted difference, see README)
    st.sampled_from(["12", "12.9", "-3.5", " 7 ", "x", "", "1e2", None, True, False]),
    st.lists(st.integers(0, 5), max_size=2), st.fixed_dictionaries({"a": st.integers(0, 5)}))


def py_count(d: dict):
    for k in P.COUNT_KEYS:
        if k in d:
            try:
                return int(float(d[k]))
            except (ValueError, TypeError):
                continue
    return None


@settings(max_examples=150, deadline=None)
@given(st.lists(st.dictionaries(st.sampled_from(KEYS), VALUES, max_size=5), min_size=1, max_size=40))
def test_count_from_object_matches_rules(spark, dicts):
    rows = [(i, json.dumps(d)) for i, d in enumerate(dicts)]
    df = spark.createDataFrame(rows, "i long, p string")
    got = {r.i: r.c for r in df.select("i", P.count_from_object(P.parse_object("p")).alias("c")).collect()}
    for i, d in enumerate(dicts):
        assert got[i] == py_count(d), (d, got[i])
