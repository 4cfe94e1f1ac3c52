import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from stratus.operators.dedup import desc_nulls_first, distinct_on, duplicate_keys, latest_per_key
from stratus.operators.keys import surrogate_key


def test_distinct_on_newest_with_nulls_first(spark):
    df = spark.createDataFrame([("a", 1, "2024-01-01"), ("a", 1, None), ("a", 2, "2024-01-03"), ("a", 2, "2024-01-02")],
                               "k string, h int, load_dts string")
    out = {(r.k, r.h): r.load_dts for r in distinct_on(df, ["k", "h"], "load_dts").collect()}
    # PostgreSQL's DESC puts NULL first, so the NULL-stamped row wins for (a, 1)
    assert out == {("a", 1): None, ("a", 2): "2024-01-03"}


def test_latest_per_key_tiebreak(spark):
    df = spark.createDataFrame([(1, "2024", "b"), (1, "2024", "a")], "k int, t string, v string")
    r = latest_per_key(df, ["k"], [desc_nulls_first("t"), F.col("v")]).collect()
    assert [x.v for x in r] == ["a"]


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert [(r.k, r.record_count) for r in duplicate_keys(df, ["k"]).collect()] == [(1, 2)]


def test_surrogate_key_equals_global_row_number(spark):
    rnd = random.Random(7)
    keys = list({f"{rnd.randint(0, 10**6):07d}" for _ in range(500)})
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, v int").repartition(5)
    got = {r.k: r.id for r in surrogate_key(df, "k", num_partitions=3).collect()}
    want = {r.k: r.id for r in df.select("k", F.row_number().over(Window.orderBy("k")).alias("id")).collect()}
    assert got == want
