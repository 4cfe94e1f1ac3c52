"""The hourly feed: Structured Streaming over landed files equals the batch model, whatever the batching."""

from pyspark.sql import functions as F

from stratus.plans import models
from stratus.plans.warehouse import Warehouse
from stratus.streaming import feed

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(tuple(r) for r in df.select("wmo_station_id", "timestamp_utc", "load_dts", "outlier_flag").collect())


def test_stream_equals_batch_and_replay_is_harmless(spark, tmp_dir):
    raw = Warehouse(spark, SF).raw_weather("observed")
    feed.land(raw, tmp_dir + "/landing")
    q = feed.start_hourly_feed(spark, tmp_dir + "/landing", tmp_dir + "/log", tmp_dir + "/ckpt", "observed",
                               max_files_per_trigger=5)
    q.awaitTermination()
    assert q.lastProgress is not None
    want = _rows(models.stg_weather(raw, "observed"))
    assert _rows(feed.current_state(spark, tmp_dir + "/log")) == want
    # a second stream over the same landing folder with a fresh checkpoint replays every file
    q2 = feed.start_hourly_feed(spark, tmp_dir + "/landing", tmp_dir + "/log", tmp_dir + "/ckpt2", "observed")
    q2.awaitTermination()
    assert _rows(feed.current_state(spark, tmp_dir + "/log")) == want
    compacted = feed.compact(spark, tmp_dir + "/log", tmp_dir + "/log_compact")
    assert _rows(compacted.current()) == want
    assert compacted.log().select(F.countDistinct("_run")).first()[0] == 1
