"""Compaction of the raw table that ingest writes a folder per micro-batch.

``compact`` folds the finished leaf folders (``run=/batch=/date=``) of each date, and what
earlier compactions made of that date, into one leaf of files of ``FILE_ROWS`` rows. It
works in three steps, each of which may be repeated:

1. the merged rows are written as the leaves of a new run ``compact-<id>``;
2. a manifest that names the leaves they replace is put in place by one rename: from then
   on, and not before, ``read_raw`` reads the new leaves instead of the old ones;
3. the replaced folders are deleted.

A compaction that stops before step 2 has changed nothing (its leaves are not read, and
the next one deletes them); one that stops after it is finished by the next one. A run's
last batch is left alone: a restarted stream may write it again.
"""

from __future__ import annotations

import json
import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from .store import FILE_ROWS, rows_by_date, write_days

MANIFESTS = "_manifests"
COMPACT = "compact-"


class Leaf(NamedTuple):
    run: str
    batch: int
    date: str

    def path(self, root: str) -> str:
        return f"{root}/run={self.run}/batch={self.batch}/date={self.date}"


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """What follows ``prefix`` in the names of the folders and files below ``path``."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    found = (s.getPath().getName() for s in fs.listStatus(p))
    return sorted(n[len(prefix):] for n in found if n.startswith(prefix))


def _manifests(spark: SparkSession, root: str) -> dict[str, list[Leaf]]:
    """The leaves that each finished compaction replaced."""
    out = {}
    for name in _names(spark, f"{root}/{MANIFESTS}", ""):
        if name.endswith(".json"):
            text = spark.read.text(f"{root}/{MANIFESTS}/{name}", wholetext=True).first()[0]
            out[name[:-5]] = [Leaf(*leaf) for leaf in json.loads(text)]
    return out


def _leaves(spark: SparkSession, root: str) -> list[Leaf]:
    return [Leaf(run, int(batch), date) for run in _names(spark, root, "run=")
            for batch in _names(spark, f"{root}/run={run}", "batch=")
            for date in _names(spark, f"{root}/run={run}/batch={batch}", "date=")]


def current_leaves(spark: SparkSession, root: str) -> list[Leaf]:
    """The leaves that hold the table's rows: finished compactions, and what none of them replaced."""
    manifests = _manifests(spark, root)
    gone = {leaf for replaced in manifests.values() for leaf in replaced}
    return [leaf for leaf in _leaves(spark, root)
            if leaf not in gone and (not leaf.run.startswith(COMPACT) or leaf.run[len(COMPACT):] in manifests)]


def _read(spark: SparkSession, root: str, leaves: list[Leaf]) -> DataFrame:
    return spark.read.option("basePath", root).parquet(*[leaf.path(root) for leaf in leaves])


def read_raw(spark: SparkSession, root: str) -> DataFrame:
    """The raw table, every row once, whatever compactions have run or stopped."""
    return _read(spark, root, current_leaves(spark, root)).drop("run", "batch")


def open_raw(spark: SparkSession, root: str) -> DataFrame:
    """A stored raw table, whether in a folder per micro-batch or plainly by date."""
    return read_raw(spark, root) if _names(spark, root, "run=") else spark.read.parquet(root)


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _finish(spark: SparkSession, root: str) -> None:
    """Deletes what finished compactions replaced, and the leaves of unfinished ones."""
    manifests = _manifests(spark, root)
    for leaf in {leaf for replaced in manifests.values() for leaf in replaced}:
        _delete(spark, leaf.path(root))
    for run in _names(spark, root, "run="):
        if run.startswith(COMPACT) and run[len(COMPACT):] not in manifests:
            _delete(spark, f"{root}/run={run}")


def _commit(spark: SparkSession, root: str, name: str, leaves: list[Leaf]) -> None:
    fs, draft = _fs(spark, f"{root}/{MANIFESTS}/{name}.draft")
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps(leaves).encode()))
    out.close()
    _, final = _fs(spark, f"{root}/{MANIFESTS}/{name}.json")
    if not fs.rename(draft, final):
        raise OSError(f"manifest {name} could not be put in place")


def compact(spark: SparkSession, root: str, file_rows: int = FILE_ROWS) -> int:
    """Folds the finished leaves below ``root``; the number of leaves replaced."""
    _finish(spark, root)
    leaves = current_leaves(spark, root)
    last = {}
    for leaf in leaves:
        last[leaf.run] = max(last.get(leaf.run, -1), leaf.batch)
    fresh = [leaf for leaf in leaves if not leaf.run.startswith(COMPACT) and leaf.batch < last[leaf.run]]
    dates = {leaf.date for leaf in fresh}
    folded = fresh + [leaf for leaf in leaves if leaf.run.startswith(COMPACT) and leaf.date in dates]
    if not fresh:
        return 0
    rows = _read(spark, root, folded).drop("run", "batch")
    name = uuid.uuid4().hex
    write_days(rows, f"{root}/run={COMPACT}{name}/batch=0", rows_by_date(rows), [c for c in rows.columns if c != "date"], file_rows)
    _commit(spark, root, name, folded)
    _finish(spark, root)
    return len(folded)
