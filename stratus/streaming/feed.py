"""The hourly feed as a Structured Streaming job.

``readStream`` over the landing zone (raw weather rows as parquet, partitioned by load date) ->
``foreachBatch``: stage the micro-batch (presence filter, newest per key, cleaning) and append it to a
``KeyedLog`` with the epoch as run id. The current table is the log's view: newest load per key.

Why a log plus a view instead of rewriting the table each micro-batch:
* each micro-batch writes O(batch) data, never O(table);
* a retried epoch (executor or driver loss) appends rows identical to ones already there; the view's
  newest-per-key pick makes that harmless, so the sink is idempotent with the stream's checkpoint;
* micro-batch boundaries and file order do not change the result: stream == batch.
Compaction (rewriting the log as its view into a new folder) is ``compact``.

``start_gold_feed`` goes on to facts and marts: each micro-batch is taken by ``gold.Gold``, which writes the facts of
its keys and the mart states of the groups it touches. A replayed epoch comes as a later run whose keys are known, so its groups
are computed anew from staging: nothing counts twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratus.operators.incremental import KeyedLog
from stratus.plans import models
from stratus.plans.gold import Gold
from stratus.session import materialize

RAW_SCHEMA = T.StructType([
    T.StructField("wmo_station_id", T.StringType()),
    T.StructField("timestamp_utc", T.TimestampNTZType()),
    T.StructField("raw", T.StringType()),
    T.StructField("bright_sky_source_mapping", T.StringType()),
    T.StructField("record_source", T.StringType()),
    T.StructField("load_dts", T.TimestampNTZType()),
    T.StructField("load_date", T.DateType()),
])

KEYS = {
    "observed": ["wmo_station_id", "timestamp_utc"],
    "forecast": ["wmo_station_id", "timestamp_utc", "batch_id"],  # every load date is a version
}


def land(raw: DataFrame, landing: str) -> None:
    """Drop raw rows into the landing zone, one folder per load date (what an ingest job would do)."""
    raw.withColumn("load_date", F.to_date("load_dts")).write.mode("append").partitionBy("load_date").parquet(landing)


def start_hourly_feed(spark: SparkSession, landing: str, log_path: str, checkpoint: str, kind: str = "observed",
                      max_files_per_trigger: int | None = None, available_now: bool = True):
    log = _log(spark, log_path, kind)

    def process(batch: DataFrame, epoch: int) -> None:
        log.append(_staged(batch, kind), epoch)

    return _start(spark, landing, checkpoint, process, max_files_per_trigger, available_now)


def start_gold_feed(spark: SparkSession, landing: str, root: str, checkpoint: str, bridge: Callable[[], DataFrame],
                    kind: str = "observed", max_files_per_trigger: int | None = None, available_now: bool = True):
    """Staging, facts and mart of ``kind`` under ``root``, fed by the stream. ``bridge`` is asked for the bridge of now
    (``models.area_bridge``, a written table) at each micro-batch, so dimensions rebuilt meanwhile take effect."""
    def process(batch: DataFrame, epoch: int) -> None:
        gold = gold_of(spark, root, kind)
        gold.advance(materialize(_staged(batch, kind), "feed_batch"), gold.staging.next_run(), bridge())

    return _start(spark, landing, checkpoint, process, max_files_per_trigger, available_now)


def gold_of(spark: SparkSession, root: str, kind: str) -> Gold:
    """The tables a gold feed keeps: ``staged()``, ``fact()``, ``mart()``."""
    return Gold(spark, root, kind, newest="load", tie=models.TIE)


def _log(spark: SparkSession, path: str, kind: str) -> KeyedLog:
    return KeyedLog(spark, path, KEYS[kind], tie=models.TIE)


def _staged(batch: DataFrame, kind: str) -> DataFrame:
    versions = kind == "forecast"
    if versions:
        batch = batch.withColumn("batch_id", F.col("load_date"))
    return models.stg_weather(batch.drop("load_date"), kind, batch_key=versions, keep_tie=True)


def _start(spark: SparkSession, landing: str, checkpoint: str, process, max_files_per_trigger: int | None,
           available_now: bool):
    reader = spark.readStream.schema(RAW_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    w = reader.parquet(landing).writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 hour")
    return w.start()


def current_state(spark: SparkSession, log_path: str, kind: str = "observed") -> DataFrame:
    """The staged table: newest load per key over the log (a retried epoch's rows replace its first attempt)."""
    return _log(spark, log_path, kind).current().drop(models.TIE)


def compact(spark: SparkSession, log_path: str, out_path: str, kind: str = "observed") -> KeyedLog:
    return _log(spark, log_path, kind).compact(out_path)
