"""Landed raw files: the events are dealt out, not the documents made of them."""

from pyspark.sql import functions as F

from stratus.plans.warehouse import Warehouse
from stratus.sources.standins import weather_raw_from_events


def test_landing_deals_out_events_not_documents(spark, tmp_dir):
    events = spark.range(3000).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 97 % 2500000).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 40).alias("user_id"), F.lit("view").alias("event_type"), (F.col("id") % 100).cast("double").alias("value"),
        F.concat(F.lit('{"k": '), (F.col("id") % 97).cast("string"), F.lit("}")).alias("props"))
    events.write.parquet(f"{tmp_dir}/events.parquet")
    wh = Warehouse(spark, tmp_dir)
    # the documents' projection stands above the exchange
    top, *below = wh.raw_rows("observed", 3)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert top.startswith("Project")
    assert any("Repartition" in line for line in below)
    raw = wh.raw_weather("observed")
    want = weather_raw_from_events(spark.read.parquet(f"{tmp_dir}/events.parquet"))
    assert raw.exceptAll(want).count() == 0 and want.exceptAll(raw).count() == 0
    # the stamps of a file ascend
    rows = raw.select(F.col("_metadata.file_path").alias("f"), "load_dts").withColumn("n", F.monotonically_increasing_id())
    stamps = {}
    for r in rows.orderBy("n").collect():
        stamps.setdefault(r.f, []).append(r.load_dts)
    assert all(s == sorted(s) for s in stamps.values()) and len(stamps) > 1
