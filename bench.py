"""Benchmark of the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query is run to completion with the ``noop`` sink (full computation,
nothing collected to the driver).
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from sensorbay.operators import clean as CL  # noqa: E402
from sensorbay.operators import decompose as DC  # noqa: E402
from sensorbay.operators import forecast as FC  # noqa: E402
from sensorbay.operators import resample as RS  # noqa: E402
from sensorbay.plans import catalog  # noqa: E402
from sensorbay.session import get_spark  # noqa: E402
from sensorbay.sources import tables as T  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn):
    t0 = time.perf_counter()
    run(fn())
    return time.perf_counter() - t0


def main():
    spark = get_spark(f"local[{CPUS}]", CPUS, extra={"spark.driver.memory": "16g"})
    ev = T.load(spark, SF_DIR, "events")
    n_events = ev.count()
    q = {}
    # warm-up (JVM code paths, Python workers) on the smallest scale, a different table
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm):
        run(CL.clean(T.readings_from_events(T.load(spark, warm, "events"), "type")))
        for name in ("clean_one_sensor", "payload_route", "profile_forecast", "backtest_metrics",
                     "accuracy_at_cutoff", "classical_decompose", "stream_ingest"):
            run(catalog.QUERIES[name](spark, warm))
    run(catalog.QUERIES["hourly_mean"](spark, SF_DIR))

    by_user = T.readings_from_events(ev, "user")
    by_type = T.readings_from_events(ev, "type")
    q["clean_pipeline"] = timed(lambda: CL.clean(by_user))
    q["clean_skewed_plain"] = timed(lambda: CL.clean(by_type))
    q["clean_skewed_chunked"] = timed(lambda: CL.clean(by_type, chunk_rows=2_000))
    q["clean_one_sensor"] = timed(lambda: catalog.QUERIES["clean_one_sensor"](spark, SF_DIR))
    q["hourly_mean"] = timed(lambda: catalog.QUERIES["hourly_mean"](spark, SF_DIR))
    for name in ("payload_route", "profile_forecast", "backtest_metrics", "accuracy_at_cutoff",
                 "classical_decompose", "stream_ingest"):
        q[name] = timed(lambda: catalog.QUERIES[name](spark, SF_DIR))

    # model stages on a materialised hourly history (so the timing is the model's)
    hist = RS.hourly_mean(CL.clean(by_type), "people").checkpoint(eager=True)
    n_series = hist.select("sensor_id").distinct().count()
    q["logistic_forecast"] = timed(lambda: FC.run_forecast(hist, model="logistic"))
    q["stl"] = timed(lambda: DC.stl_decompose(DC.prepare_grid(hist)))

    total = sum(q.values())
    rates = {
        "clean_rows_per_s": n_events / q["clean_pipeline"],
        "clean_skewed_plain_rows_per_s": n_events / q["clean_skewed_plain"],
        "clean_skewed_chunked_rows_per_s": n_events / q["clean_skewed_chunked"],
        "clean_one_sensor_rows_per_s": n_events / q["clean_one_sensor"],
        "forecast_series_per_s": n_series / q["logistic_forecast"],
        "stl_series_per_s": n_series / q["stl"],
        "stream_messages_per_s": n_events / q["stream_ingest"],
    }
    print(json.dumps({"metric": "total_query_seconds", "value": round(total, 3), "unit": "sec",
                      "queries": {k: round(v, 3) for k, v in q.items()},
                      "rates": {k: round(v, 1) for k, v in rates.items()},
                      "sf": os.path.basename(SF_DIR.rstrip("/")).replace("sf", ""),
                      "cpus": CPUS, "events": n_events}))


if __name__ == "__main__":
    main()
