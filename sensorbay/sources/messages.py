"""Sensor messages ``(msg_id, topic, payload, arrival_ts)``.

:func:`messages_from_events` derives one message per ``events`` row; the
payload shape cycles through the cases the collector must handle (other count
keys, float text, bad first key, malformed JSON, arrays, missing id, odd ids,
multi-metric payloads), chosen by ``event_id % 8`` so every row is used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType, LongType

from .tables import sensor_of

MESSAGE_SCHEMA = StructType([
    StructField("msg_id", LongType()),
    StructField("topic", StringType()),
    StructField("payload", StringType()),
    StructField("arrival_ts", TimestampType()),
])


def messages_from_events(events: DataFrame, topic_root: str = "sensors") -> DataFrame:
    sid = sensor_of(events, "type")
    k = F.get_json_object("props", "$.k")
    q = lambda s: F.concat(F.lit('"'), s, F.lit('"'))
    variant = F.col("event_id") % 8
    t = (k.cast("double") - 35.5).cast("string")
    co2 = (k.cast("int") * 50 + 300).cast("string")
    payload = (
        F.when(variant == 0, F.concat(F.lit('{"id":'), q(sid), F.lit(',"pCount":'), k, F.lit("}")))
        .when(variant == 1, F.concat(F.lit('{"id":'), q(sid), F.lit(',"people":"'), k, F.lit('.9"}')))
        .when(variant == 2, F.concat(F.lit('{"id":'), q(sid), F.lit(',"person count":'), k, F.lit(',"count":3}')))
        .when(variant == 3, F.concat(F.lit('{"id":'), q(F.concat(sid, F.lit("/b c"))),
                                     F.lit(',"person_count":"x","people":'), k, F.lit("}")))
        .when(variant == 4, F.concat(F.lit('{"id":'), q(sid), F.lit(',"people":'), k))
        .when(variant == 5, F.concat(F.lit("["), k, F.lit(","), k, F.lit("]")))
        .when(variant == 6, F.concat(F.lit('{"people":'), k, F.lit("}")))
        .otherwise(F.concat(F.lit('{"id":'), q(sid), F.lit(',"T":'), t, F.lit(',"H":'), k,
                            F.lit(',"CO2":"'), co2, F.lit('","pCount":'), k, F.lit("}"))))
    return events.select(F.col("event_id").alias("msg_id"),
                         F.concat(F.lit(topic_root + "/"), sid).alias("topic"),
                         payload.alias("payload"),
                         F.col("ts").cast("timestamp").alias("arrival_ts"))
