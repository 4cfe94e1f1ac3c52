"""Keyed incremental maintenance of written tables (the reference's incremental models).

* ``high_water_mark`` / ``incremental_filter``: take raw rows loaded after the target's newest load stamp
  (an empty target takes everything — the reference would then never select rows again, quirk Q5).
* ``replace_by_key``: delete target rows whose key occurs in the batch, insert the batch (a batch may
  hold several rows per key, e.g. fact rows fanned out per area) — an anti-join plus a union.
* ``append_versions``: forecast history — the batch id is part of the key, so each batch adds a version.
* ``KeyedLog``: the same on a written table without rewriting it: versions and delete marks per key.
* ``write_fresh``: a table that is rebuilt goes to a folder of its own, whose path the caller passes on; a
  failed or retried job leaves nothing that anyone reads.
"""

from __future__ import annotations

import math
import time
import uuid
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratus.operators.joins import few_rows


def high_water_mark(target: DataFrame, col: str = "load_dts"):
    """Scalar newest load stamp of the target (None when empty); one aggregate row to the driver."""
    return target.agg(F.max(col).alias("hwm")).first()["hwm"]


def incremental_filter(raw: DataFrame, target: DataFrame | None, col: str = "load_dts") -> DataFrame:
    """Rows loaded after the target's newest load.

    The mark is read from the target's newest ``load_date`` partition only (when the target is
    partitioned that way), travels as NTZ text (no time-zone shift between driver and session), and
    becomes a literal predicate: pushed into the parquet scan (row-group statistics) and, when the raw
    layer is partitioned by ``load_date``, a partition filter too.
    """
    if target is None:
        return raw
    if "load_date" in target.columns:
        last = target.agg(F.max("load_date")).first()[0]
        if last is None:
            return raw
        target = target.filter(F.col("load_date") == F.lit(last))
    hwm = target.agg(F.date_format(F.max(col), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("hwm")).first()["hwm"]
    if hwm is None:
        return raw
    mark = F.lit(hwm).cast(raw.schema[col].dataType)
    out = raw.filter(F.col(col) > mark)
    if "load_date" in raw.columns:
        out = out.filter(F.col("load_date") >= F.to_date(mark))
    return out


def replace_by_key(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """New content of a keyed table: target rows without a key in the batch, plus the whole batch.
    Columns new in the batch are added (old rows get NULL); columns missing from it stay."""
    batch_keys = batch.select(*keys).distinct()
    kept = target.join(batch_keys, list(keys), "left_anti")
    return kept.unionByName(batch, allowMissingColumns=True)


def append_versions(target: DataFrame, batch: DataFrame, keys: Sequence[str], batch_col: str = "batch_id") -> DataFrame:
    """Versioned history: the batch id joins the key, so other batches' versions are kept."""
    return replace_by_key(target, batch, list(keys) + [batch_col])


def evolve_schema(old: DataFrame, new_schema: T.StructType) -> DataFrame:
    """``on_schema_change='append_new_columns'``: add columns that are new, as NULL; keep removed ones."""
    out = old
    for f in new_schema.fields:
        if f.name not in old.columns:
            out = out.withColumn(f.name, F.lit(None).cast(f.dataType))
    return out


ROWS_A_TASK = 50_000


def tasks_for(df: DataFrame) -> int:
    """Tasks of about ``ROWS_A_TASK`` rows each for a written table. Adaptive execution sizes tasks by packed bytes, and rows
    that repeat a station's measures for each of its areas pack so well that a task's rows would not fit its memory."""
    return max(math.ceil(df.count() / ROWS_A_TASK), 1)


def write_fresh(df: DataFrame, root: str) -> str:
    """Write ``df`` to a new folder under ``root`` and return its path."""
    path = f"{root}/v-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return path


class KeyedLog:
    """Keyed table kept as an append-only log of runs plus a view (merge-on-read).

    ``append(batch, run)`` writes only the batch (O(batch) per run, never O(table)); files become visible
    at job commit, so a failed run leaves nothing behind. ``current()`` is the table: per key, the rows of its
    newest version. With several rows per key (fact rows fanned out per area) the whole group of the winning
    version is kept, which is the delete+insert semantics. Keys given as ``gone`` have a newest version without
    rows (a delete mark): they are in the table again once a later run has rows for them.

    ``newest`` says which version wins:
    * ``"load"``: the newest load, whatever run brought it (a missing stamp counts as newest, as in staging);
      among equal loads the smallest ``tie`` column if there is one (staging's document hash), then the later run,
      then the later attempt. Micro-batch boundaries do not change the result.
    * ``"run"``: the later run, then the later attempt, whatever the stamps say: what ``replace_by_key`` does.

    A retried run replaces its earlier attempt instead of duplicating it. The view is one read and one shuffle by key,
    limited to the newest versions before it. ``compact`` rewrites the view as a fresh log.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], partition_by: Sequence[str] = ("load_date",),
                 merge_schema: bool = True, newest: str = "load", tie: str | None = None):
        if newest not in ("load", "run"):
            raise ValueError(newest)
        self.spark, self.root, self.keys, self.partition_by = spark, root, list(keys), list(partition_by)
        self.merge_schema = merge_schema  # columns that a later run adds stay (append_new_columns)
        self.newest, self.tie = newest, tie

    def _exists(self) -> bool:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        p = jvm.org.apache.hadoop.fs.Path(self.root)
        fs = p.getFileSystem(conf)
        if not fs.exists(p):
            return False
        files = fs.listFiles(p, True)  # a run without rows leaves no data file, or none in a partition
        while files.hasNext():
            if files.next().getPath().getName().startswith("part-"):
                return True
        return False

    def append(self, batch: DataFrame, run: int, gone: DataFrame | None = None) -> None:
        """Add a run's rows, and delete marks for the keys in ``gone``."""
        out = batch.withColumn("_gone", F.lit(False))
        if gone is not None:
            out = out.unionByName(gone.select(*self.keys).withColumn("_gone", F.lit(True)), allowMissingColumns=True)
        # attempts are ordered by their write stamp, so the latest one of a run wins
        out = out.withColumn("_run", F.lit(run).cast("long")).withColumn("_attempt", F.lit(time.time_ns()))
        if "load_date" in self.partition_by and "load_date" not in batch.columns:
            out = out.withColumn("load_date", F.to_date("load_dts"))
        if "event_date" in self.partition_by:
            # few files a day, and a day that holds most of the batch is split by size
            out = out.withColumn("event_date", F.to_date("timestamp_utc")).hint("rebalance", "event_date")
        writer = out.write.mode("append")
        (writer.partitionBy(*self.partition_by) if self.partition_by else writer).parquet(self.root)

    def log(self) -> DataFrame | None:
        if not self._exists():
            return None
        return self.spark.read.option("mergeSchema", str(self.merge_schema).lower()).parquet(self.root)

    def rows(self, days: Sequence | None = None, before: int | None = None) -> DataFrame | None:
        """The log's rows; of the given event dates (a partition filter), of runs before ``before``."""
        log = self.log()
        if log is not None and days is not None:
            found = F.col("event_date").isin([d for d in days if d is not None])
            log = log.filter(found | F.col("event_date").isNull() if None in days else found)
        if log is not None and before is not None:
            log = log.filter(F.col("_run") < before)
        return log

    def current(self, only: DataFrame | None = None, days: Sequence | None = None,
                before: int | None = None, tasks: int | None = None, bounded: bool = False) -> DataFrame | None:
        """The table; with ``only`` (a table of one or more key columns) its rows of those keys, with ``days`` those of
        these event dates, with ``before`` as it was before that run. The rows are dealt by key to ``tasks`` tasks, with
        ``bounded`` to as many as the log's rows need (``tasks_for``), else as adaptive execution finds fit."""
        log = self.rows(days, before)
        if log is None:
            return None
        if bounded:
            tasks = tasks_for(log)
        if only is not None:
            few = few_rows(only)
            if not few and tasks is not None and sorted(only.columns) == sorted(self.keys):
                log, tasks = log.repartition(tasks, *self.keys), None  # as the join needs them, dealt once
            log = log.join(only if few else only.hint("merge"), only.columns, "left_semi")
        if tasks is not None:
            log = log.repartition(tasks, *self.keys)
        order = [F.col("_run").desc(), F.col("_attempt").desc()]
        if self.newest == "load":
            ties = [F.col(self.tie).asc_nulls_last()] if self.tie else []
            order = [F.col("load_dts").desc_nulls_first(), *ties, *order]
        version = F.rank().over(Window.partitionBy(*self.keys).orderBy(*order))
        return log.withColumn("_version", version).filter((F.col("_version") == 1) & ~F.col("_gone")) \
            .drop("_version", "_gone", "_run", "_attempt", *self.partition_by)

    def written_by(self, run: int) -> DataFrame | None:
        """Rows and delete marks (``_gone``) that the newest attempt of ``run`` wrote; files of other runs are skipped by
        their statistics."""
        log = self.log()
        if log is None:
            return None
        log = log.filter(F.col("_run") == run)
        last = log.agg(F.max("_attempt")).first()[0]
        return None if last is None else log.filter(F.col("_attempt") == last).drop("_run", "_attempt", *self.partition_by)

    def next_run(self) -> int:
        """A run number after all runs in the log."""
        log = self.log()
        last = None if log is None else log.agg(F.max("_run")).first()[0]
        return 0 if last is None else last + 1

    def high_water_mark(self):
        log = self.log()
        return None if log is None else high_water_mark(log)

    def compact(self, new_root: str) -> "KeyedLog":
        cur = self.current()
        nxt = KeyedLog(self.spark, new_root, self.keys, self.partition_by, self.merge_schema, self.newest, self.tie)
        if cur is not None:
            nxt.append(cur, self.next_run() - 1)
        return nxt
