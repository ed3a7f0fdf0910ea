"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorbay.session import scratch_path

#: White space between words: space and the control characters tab to carriage return.
SPACE = r"[\x20\x09-\x0D]+"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words(text: Column | str) -> Column:
    """Runs of non-space characters, in order; no words for NULL or blank text."""
    col = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.coalesce(col, F.lit("")), SPACE), lambda w: w != "")


def ascii_lower(text: Column | str) -> Column:
    """A-Z lower-cased, every other character kept."""
    col = F.col(text) if isinstance(text, str) else text
    return F.translate(col, ASCII_UPPER, ASCII_UPPER.lower())


#: Paths staged in the innermost ``scratch`` block.
_staged: ContextVar[list[str] | None] = ContextVar("staged", default=None)


def stage(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write ``df`` as a table below ``spark.checkpoint.dir`` and read it back.

    The files are shared by all executors, so what follows survives the loss of any
    of them; they are narrow, columnar and compressed, unlike a checkpointed RDD.
    Inside a ``scratch`` block they go at its end, unless ``keep``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    paths = _staged.get()
    if paths is not None and not keep:
        paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir`` that goes with the innermost ``scratch`` block."""
    path = scratch_path(spark, name)
    paths = _staged.get()
    if paths is not None:
        paths.append(path)
    return path


#: Narrow rows (ids, digests) that may be shipped to every task: some 12 MB.
SHIPPED_ROWS = 200_000


def join_checked(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join with a staged table of narrow rows: shipped if counted small enough, else a shuffled join."""
    few = small.limit(SHIPPED_ROWS + 1).count() <= SHIPPED_ROWS
    return big.join(F.broadcast(small) if few else small, on, how)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes what was staged inside; results that outlive the block are staged with ``keep``."""
    paths: list[str] = []
    token = _staged.set(paths)
    try:
        yield
    finally:
        _staged.reset(token)
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for path in paths:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)


@contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Rows of a Python batch for the jobs run inside: fewer where a row is large."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def partitions(spark: SparkSession, rows: int, rows_per_part: int) -> int:
    """Enough parts for ``rows_per_part`` rows each, and no fewer than a shuffle has."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_per_part), 1)
