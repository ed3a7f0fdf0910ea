"""Message ingest (T1/T2): one transform shared by batch and Structured Streaming.

Per message: decode (F15) -> parse (F1) -> route to a raw point (F2-F9), a
device-log line (F9-F12, W5) and, for undecodable or malformed input, a dead
letter. All stateless, so a micro-batch is processed exactly like a batch.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import config as C
from ..functions import payload as P
from ..sources.messages import MESSAGE_SCHEMA
from ..sources.tables import DEVICE_BUCKETS, device_bucket
from . import run_id

RAW_COLUMNS = ["sensor_id", "ts", "valid", "people", "temperature", "humidity", "co2"]


def parsed(messages: DataFrame, capacity: dict | None = None) -> DataFrame:
    """Adds ``_utf8`` and ``_m`` (the payload as a map, NULL unless one JSON object).

    A frame that is already parsed is returned as it is.
    """
    if "_m" in messages.columns and "_utf8" in messages.columns:
        return messages
    text = P.payload_text("payload")
    return messages.select("*", P.utf8_ok("payload").alias("_utf8"),
                           P.parse_object(text).alias("_m"))


def _emit(df: DataFrame, keep, cols: list) -> DataFrame:
    """Rows of ``cols`` where ``keep`` holds, as a generator instead of a filter.

    A filter on the derived columns would be pushed below the projection that
    parses the payload and re-parse it once per referenced key; ``inline`` of a
    0/1-element array keeps the parse to one per message.
    """
    # fields first, in a projection (subexpression elimination, whole-stage codegen),
    # then the generator over plain column references
    proj = df.select(*cols, F.coalesce(keep, F.lit(False)).alias("_keep"))
    names = [c for c in proj.columns if c != "_keep"]
    row = F.when(F.col("_keep"), F.array(F.struct(*[F.col(n) for n in names]))).otherwise(F.array())
    return proj.select(F.inline(row))


def raw_points(messages: DataFrame, capacity: dict | None = None, keep_id: bool = False) -> DataFrame:
    """W1 rows: ``sensor_id, ts, valid, people, temperature, humidity, co2``.

    A row per readable JSON object that yields at least one field.
    """
    p = parsed(messages)
    looked_up = capacity
    if capacity is not None and len(capacity) > C.LITERAL_CONFIG_ROWS:
        p = C.with_capacity(p.withColumn("_sid", P.sensor_id(F.col("_m"))), capacity, C.DEFAULT_CAPACITY_VALIDATE, "_sid", "_bound")
        looked_up = F.col("_bound")
    f = P.route_fields(F.col("_m"), looked_up)
    cols = [f["sensor_id"].alias("sensor_id"), F.col("arrival_ts").cast("timestamp_ntz").alias("ts"),
            f["valid"].alias("valid"), f["people"].alias("people"), f["temperature"].alias("temperature"),
            f["humidity"].alias("humidity"), f["co2"].alias("co2")]
    if keep_id:
        cols = [F.col("msg_id").alias("msg_id")] + cols
    proj = p.select(*cols, (F.col("_utf8") & F.col("_m").isNotNull()).alias("_ok"))
    any_field = (F.col("people").isNotNull() | F.col("temperature").isNotNull()
                 | F.col("humidity").isNotNull() | F.col("co2").isNotNull())
    return _emit(proj, F.col("_ok") & any_field, [F.col(c) for c in proj.columns if c != "_ok"])


def device_log(messages: DataFrame, keep_id: bool = False) -> DataFrame:
    """W5 rows ``device, timestamp, topic, payload`` for every payload that is a JSON object."""
    p = parsed(messages)
    cols = [P.device_name(P.sensor_id(F.col("_m"))).alias("device"),
            P.iso_utc("arrival_ts").alias("timestamp"), F.col("topic").alias("topic"),
            P.flatten_payload("payload").alias("payload")]
    if keep_id:
        cols = [F.col("msg_id").alias("msg_id")] + cols
    return _emit(p, F.col("_utf8") & F.col("_m").isNotNull(), cols)


def dead_letters(messages: DataFrame, keep_id: bool = False) -> DataFrame:
    """Messages that yield nothing because they cannot be read: bad UTF-8, not a JSON object."""
    p = parsed(messages)
    reason = (F.when(~F.col("_utf8"), F.lit("invalid_utf8"))
              .when(F.col("_m").isNull(), F.lit("not_json_object")))
    cols = [F.col("topic").alias("topic"), P.payload_text("payload").alias("payload"),
            F.col("arrival_ts").cast("timestamp_ntz").alias("arrival_ts"), reason.alias("reason")]
    if keep_id:
        cols = [F.col("msg_id").alias("msg_id")] + cols
    return _emit(p, reason.isNotNull(), cols)


def write_device_log(log: DataFrame, path: str, mode: str = "overwrite", buckets: int = DEVICE_BUCKETS) -> None:
    """Header line, RFC-4180 quoting (the payload holds commas), lines ordered by device and time.

    Devices are dealt by hash over ``buckets`` folders, so a batch writes as many files at
    most, however many devices it holds; :func:`sensorbay.sources.tables.read_backup` opens
    one device's folder alone.
    """
    (log.select("device", "timestamp", "topic", "payload").withColumn("bucket", device_bucket(F.col("device"), buckets))
     .repartition("bucket").sortWithinPartitions("bucket", "device", "timestamp").write.mode(mode).partitionBy("bucket")
     .option("header", "true").option("quote", '"').option("escape", '"').csv(path))


def write_batch(messages: DataFrame, out_dir: str, batch_id: int = 0, run: str | None = None) -> None:
    """Write raw points, the device log and dead letters of one (micro-)batch.

    Each batch lands in its own ``run=<run>/batch=<id>`` folder. A replay of a run's
    batch replaces what it wrote before; another run (without ``run``: every call)
    only adds. F13: each message brings its arrival time; a source without one is
    refused, as one instant for a whole batch would make different messages one point.
    """
    if "arrival_ts" not in messages.columns:
        raise ValueError("messages need an arrival time (arrival_ts) of their own")
    sub = f"/run={run or uuid.uuid4()}/batch={batch_id}"
    if "msg_id" not in messages.columns:
        messages = messages.withColumn("msg_id", F.lit(None).cast("long"))
    # parsed once, cached, and read by the three sinks
    messages = parsed(messages).persist()
    try:
        (raw_points(messages, keep_id=True).withColumn("date", F.to_date("ts"))
         .write.mode("overwrite").partitionBy("date").parquet(f"{out_dir}/raw{sub}"))
        write_device_log(device_log(messages), f"{out_dir}/device_log{sub}")
        dead_letters(messages).write.mode("overwrite").parquet(f"{out_dir}/dead_letters{sub}")
    finally:
        messages.unpersist()


def start_ingest(spark: SparkSession, source_dir: str, out_dir: str, checkpoint_dir: str,
                 fmt: str = "parquet", available_now: bool = True, max_files_per_trigger: int | None = None):
    """A file-stream source of messages (``msg_id, topic, payload, arrival_ts``).

    In production the source is a message broker (``format('kafka')``, value as
    binary payload); the transform is the same. Returns the running query.
    """
    reader = spark.readStream.schema(MESSAGE_SCHEMA).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(source_dir)
    return start_stream(stream, out_dir, checkpoint_dir, available_now)


def broker_messages(spark: SparkSession, servers: str, pattern: str = "sensors/.*",
                    options: dict | None = None) -> DataFrame:
    """S1 in production: a Kafka topic-pattern subscription as messages.

    Needs the Kafka connector on the classpath (not part of this image, so not
    exercised by the tests). The broker timestamp is the arrival time; the
    value stays binary so undecodable payloads reach the dead letters.
    """
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribePattern", pattern))
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    raw = reader.load()
    return raw.select(F.col("offset").alias("msg_id"), "topic", F.col("value").alias("payload"),
                      F.col("timestamp").alias("arrival_ts"))


def start_stream(messages: DataFrame, out_dir: str, checkpoint_dir: str, available_now: bool = False):
    """T1/T2 for any streaming message frame (e.g. :func:`broker_messages`)."""
    def sink(df: DataFrame, batch_id: int) -> None:
        write_batch(df, out_dir, batch_id, run_id(df.sparkSession, checkpoint_dir))

    w = (messages.writeStream.foreachBatch(sink)
         .option("checkpointLocation", checkpoint_dir))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
