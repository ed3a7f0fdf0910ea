"""Parquet tables with point semantics: append, upsert (W2-W4), predicate delete.

A table is a Parquet folder partitioned by ``date`` (from its time column).
Writes touch only the partitions the change reaches. The old partitions are read as
folders of their own and the merged ones written with dynamic partition overwrite: Spark
writes them beside the table and puts them in place when the whole job is done, so a
folder is replaced only after it was read, and a failed job leaves the table as it was.
A day is written by as many tasks, and files, as its rows need.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

#: Rows of a file, and of the task that writes it.
FILE_ROWS = 1_000_000


def upsert_latest(old: DataFrame, new: DataFrame, keys: list[str], fields: list[str] | None = None,
                  version: str | None = None) -> DataFrame:
    """Merge ``new`` into ``old`` on ``keys``: per field, the latest non-NULL write wins.

    A point rewritten with fewer fields keeps the fields it does not mention.
    ``version`` names an ordering column present in both (latest = largest), kept in the
    result; without it ``new`` beats ``old``. Writes of equal version: the largest value. One shuffle on ``keys`` with map-side
    partial aggregation (``max_by``).
    """
    cols = list(dict.fromkeys([c for c in old.columns + new.columns if c not in keys and c != version]))
    fields = fields or cols
    ver_old = F.col(version) if version else F.lit(0)
    ver_new = F.col(version) if version else F.lit(1)
    u = (old.withColumn("_ver", ver_old)
         .unionByName(new.withColumn("_ver", ver_new), allowMissingColumns=True))
    # writes of one version: the largest value, so reruns agree
    aggs = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.struct("_ver", F.col(c)))).alias(c) for c in fields]
    return u.groupBy(*keys).agg(*aggs, *([F.max("_ver").alias(version)] if version else []))


def delete_predicate(df: DataFrame, start=None, end=None, tag_key: str | None = None,
                     tag_value: str | None = None, ts: str = "ts"):
    """W8 predicate: time in ``[start, end)`` AND the tag condition.

    ``tag_key`` alone means "tag present and not empty"; ``tag_value`` without
    ``tag_key`` is ignored; a tag the table does not have matches nothing.
    Defaults: start 1970-01-01, end now (UTC).
    """
    start = start or dt.datetime(1970, 1, 1)
    end = end or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    lit = lambda t: F.lit(dt.datetime.fromisoformat(t) if isinstance(t, str) else t).cast("timestamp_ntz")
    pred = (F.col(ts) >= lit(start)) & (F.col(ts) < lit(end))
    if tag_key:
        if tag_key not in df.columns:
            return F.lit(False)
        tag = F.col(tag_key).cast("string")
        pred = pred & ((tag == F.lit(tag_value)) if tag_value is not None else (tag != F.lit("")))
    return pred


def delete_where(df: DataFrame, **kw) -> DataFrame:
    """Rows that survive the delete (NULL predicate = kept)."""
    return df.where(~F.coalesce(delete_predicate(df, **kw), F.lit(False)))


# --------------------------------------------------------------------------- table helpers
def _with_date(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn("date", F.to_date(F.col(ts)))


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def _days(spark: SparkSession, path: str, dates) -> DataFrame:
    """The table's partitions of these dates, each read as a folder of its own."""
    table = spark.read.parquet(path)
    folders = [f for f in (f"{path}/date={d}" for d in dates) if _exists(spark, f)]
    if not folders:
        return table.limit(0)
    return spark.read.option("basePath", path).schema(table.schema).parquet(*folders)


def rows_by_date(df: DataFrame) -> dict[dt.date, int]:
    """Rows per date: as many entries as the frame spans days."""
    return {r["date"]: r["count"] for r in df.groupBy("date").count().collect()}


def write_days(df: DataFrame, path: str, rows: dict[dt.date, int], keys: list[str], file_rows: int = FILE_ROWS,
               mode: str = "overwrite") -> None:
    """Replaces (``mode``: or adds to) the ``date`` partitions that occur in ``df``.

    ``rows`` holds at least the number of rows of every date. A day of more than
    ``file_rows`` is dealt by a hash of ``keys`` over as many tasks as it needs, a smaller
    one is written by one; each task writes one file.
    """
    spark, first, plan = df.sparkSession, 0, []
    for date, n in sorted(rows.items(), key=lambda r: str(r[0])):
        files = max(1, -(-n // file_rows))
        plan.append((date, first, files))
        first += files
    if not plan:
        return
    # one row per day
    parts = F.broadcast(spark.createDataFrame(plan, "_date date, _first int, _files int"))
    at = (F.col("_first") + F.pmod(F.xxhash64(*keys), F.col("_files"))).cast("int")
    dealt = df.join(parts, F.col("date").eqNullSafe(F.col("_date"))).withColumn("_at", at)
    (dealt.repartitionById(first, F.col("_at")).drop("_date", "_first", "_files", "_at")
     .write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path))


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _drop_partitions(spark: SparkSession, path: str, dates) -> None:
    for d in dates:
        _delete(spark, f"{path}/date={d}")


def append(spark: SparkSession, df: DataFrame, path: str, ts: str = "ts") -> None:
    """Plain append, partitioned by date."""
    _with_date(df, ts).write.mode("append").partitionBy("date").parquet(path)


def write_part(df: DataFrame, path: str, run: str, batch: int) -> None:
    """Write one micro-batch's rows into its own folder: a replay replaces them, another run adds to them."""
    df.write.mode("overwrite").parquet(f"{path}/run={run}/batch={batch}")


def upsert_table(spark: SparkSession, new: DataFrame, path: str, keys: list[str], ts: str = "ts",
                 version: str | None = None, file_rows: int = FILE_ROWS) -> None:
    """Merge ``new`` into the table at ``path`` touching only its dates.

    The first write merges too, so equal keys in ``new`` come out the same whenever they are written.
    """
    new = _with_date(new, ts).persist()  # read twice below: its rows by date, then the merge
    try:
        rows = rows_by_date(new)
        if _exists(spark, path):
            old = _days(spark, path, rows)
            for date, n in rows_by_date(old).items():
                rows[date] += n
        else:
            old = new.limit(0)
        merged = upsert_latest(old.drop("date"), new.drop("date"), keys, version=version)
        write_days(_with_date(merged, ts), path, rows, keys, file_rows)
    finally:
        new.unpersist()


def delete_table(spark: SparkSession, path: str, confirm: bool = False, ts: str = "ts", file_rows: int = FILE_ROWS, **kw) -> int:
    """W8 on a stored table; returns the number of deleted rows. Needs ``confirm=True``."""
    if not confirm:
        raise PermissionError("delete_table is irreversible: pass confirm=True")
    df = spark.read.parquet(path)
    start, end = kw.get("start"), kw.get("end")
    lit = lambda t: F.lit(dt.datetime.fromisoformat(t) if isinstance(t, str) else t)
    if start is not None:  # prune date partitions outside the range
        df = df.where(F.col("date") >= F.to_date(lit(start)))
    if end is not None:
        df = df.where(F.col("date") <= F.to_date(lit(end)))
    pred = F.coalesce(delete_predicate(df, ts=ts, **kw), F.lit(False))
    # partition pruning first: only dates the predicate can reach are read and rewritten
    hit = rows_by_date(df.where(pred))
    if not hit:
        return 0
    touched = _days(spark, path, hit)
    rows = rows_by_date(touched)
    keys = [c for c in touched.columns if c != "date"]
    left = {d: n - hit[d] for d, n in rows.items()}
    write_days(touched.where(~pred), path, {d: n for d, n in left.items() if n}, keys, file_rows)
    # partitions the delete emptied completely are not rewritten: remove them
    _drop_partitions(spark, path, [d for d, n in left.items() if not n])
    return sum(hit.values())


def delete_tables(spark: SparkSession, paths: dict[str, str], confirm: bool = False, table: str | None = None,
                  ts: dict[str, str] | None = None, **kw) -> dict[str, int]:
    """W8 over several stored tables (name -> path): the named one, or all when none is named.

    ``ts`` names a table's time column where it is not ``ts``. Returns the rows deleted per table.
    """
    if not confirm:
        raise PermissionError("delete_tables is irreversible: pass confirm=True")
    names = [table] if table else sorted(paths)
    return {n: delete_table(spark, paths[n], confirm=True, ts=(ts or {}).get(n, "ts"), **kw) for n in names}
