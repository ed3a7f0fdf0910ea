"""Sensor configuration and engine defaults."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for the same results.
# ---------------------------------------------------------------------------
SENSOR_CAPACITY = {"aiot": 60, "robo": 60, "simulated": 150}
DEFAULT_CAPACITY_CLEAN = 60      # unknown sensor, cleaning and forecasting
DEFAULT_CAPACITY_VALIDATE = 50   # unknown sensor, payload validation
TEMP_RANGE = (-30.0, 60.0)
HUM_RANGE = (0.0, 100.0)
CO2_RANGE = (350.0, 5000.0)
HAMPEL_WINDOW = 10
HAMPEL_N_SIGMA = 3.0
SHORT_GAP_HOURS = 6
LONG_GAP_HOURS = 24
SMOOTH_WINDOW = 3
SMOOTH_SENSORS = ("simulated",)
TRAINING_DAYS = 60
FORECAST_HORIZON = 168
MIN_TRAINING_HOURS = 168
MIN_BACKTEST_HOURS = 24 * 14
MIN_ACCURACY_HOURS = 48
MIN_STL_HOURS = 48
TRAIN_FRACTION = 0.75
STL_PERIOD = 24
STL_SEASONAL = 13
# ---------------------------------------------------------------------------

# A configuration map of at most this many entries becomes a literal expression.
LITERAL_CONFIG_ROWS = 64
# A configuration map larger than this is joined by shuffle instead of broadcast.
BROADCAST_CONFIG_ROWS = 100_000


def sensor_config(spark: SparkSession, capacity: dict | None = None) -> DataFrame:
    """``sensor_id STRING, capacity DOUBLE`` from a driver-side mapping."""
    cap = SENSOR_CAPACITY if capacity is None else capacity
    rows = [(str(k), float(v)) for k, v in cap.items()]
    return spark.createDataFrame(rows, "sensor_id string, capacity double")


def with_capacity(df: DataFrame, capacity: dict | None = None, default: float = DEFAULT_CAPACITY_CLEAN,
                  key: str = "sensor_id", out: str = "capacity") -> DataFrame:
    """Attach each sensor's capacity, ``default`` for sensors not configured.

    The mapping lives on the driver, so its size is known before planning: it is
    broadcast when it has at most ``BROADCAST_CONFIG_ROWS`` entries and joined by
    shuffle otherwise.
    """
    cap = SENSOR_CAPACITY if capacity is None else capacity
    if len(cap) == 0:
        return df.withColumn(out, F.lit(float(default)))
    if len(cap) <= LITERAL_CONFIG_ROWS:
        # tiny maps become a literal CASE expression: no join at all
        expr = None
        for k, v in cap.items():
            cond = F.col(key) == F.lit(str(k))
            expr = F.when(cond, F.lit(float(v))) if expr is None else expr.when(cond, F.lit(float(v)))
        return df.withColumn(out, expr.otherwise(F.lit(float(default))))
    cfg = sensor_config(df.sparkSession, cap).withColumnRenamed("sensor_id", key) \
        .withColumnRenamed("capacity", "_cap")
    if len(cap) <= BROADCAST_CONFIG_ROWS:
        cfg = F.broadcast(cfg)
    return (df.join(cfg, key, "left")
            .withColumn(out, F.coalesce(F.col("_cap"), F.lit(float(default)))).drop("_cap"))
