"""A hot key holding a third of all rows (repeated loads of one station-hour) gives the same results."""

import datetime as dt
import json
import random

from pyspark.sql import functions as F

from stratus.plans import models


def test_hot_station_hour(spark):
    rnd = random.Random(5)
    rows = []
    base = dt.datetime(2024, 1, 1)
    for i in range(900):
        hot = i % 3 == 0
        st = "00001" if hot else f"{rnd.randint(2, 40):05d}"
        hour = base if hot else base + dt.timedelta(hours=rnd.randint(0, 47))
        load = base + dt.timedelta(minutes=i)
        doc = {"temperature": rnd.uniform(-10, 30), "precipitation": rnd.uniform(0, 5), "wind_speed": 3.0,
               "condition": rnd.choice(["rain", "sun"])}
        rows.append((st, hour, json.dumps(doc), "{}", "t", load))
    raw = spark.createDataFrame(rows, "wmo_station_id string, timestamp_utc timestamp_ntz, raw string, "
                                      "bright_sky_source_mapping string, record_source string, load_dts timestamp_ntz")
    raw = raw.repartition(6)
    stg = models.stg_weather(raw).collect()
    newest = {}
    for st, hour, doc, _, _, load in rows:
        if (st, hour) not in newest or load > newest[(st, hour)][0]:
            newest[(st, hour)] = (load, json.loads(doc)["temperature"])
    assert {(r.wmo_station_id, r.timestamp_utc): r.load_dts for r in stg} == {k: v[0] for k, v in newest.items()}
    hot = [r for r in stg if r.wmo_station_id == "00001"]
    assert len(hot) == 1 and hot[0].load_dts == base + dt.timedelta(minutes=897)
