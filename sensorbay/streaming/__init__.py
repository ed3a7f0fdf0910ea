"""Streaming jobs."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


def run_id(spark: SparkSession, checkpoint_dir: str) -> str:
    """The streaming query's own id, kept in its checkpoint: equal after a restart, new for a new checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint_dir.rstrip('/')}/metadata").first()[0])["id"]
