"""Groups of one row need no aggregate: the same mart rows, without a shuffle of the rows."""

import datetime as dt

from stratus.functions import spec
from stratus.operators.dedup import by_group_size
from stratus.plans import models
from stratus.session import materialize

GROUP = ["plz", "timestamp_utc"]
T0 = dt.datetime(2024, 1, 1)
SCHEMA = ("postal_area_id long, plz string, timestamp_utc timestamp_ntz, weather_condition string, weather_icon string, outlier_flag string, "
          "confidence_score double, load_dts timestamp_ntz, " + ", ".join(f"{m} double" for m in spec.MEASURE_NAMES))


def _row(area, hour, temperature, value=1.0, flag=None, text="rain", hours=True):
    rest = [temperature] + [value] * (len(spec.MEASURE_NAMES) - 1)
    return (area, f"plz{area}", T0 + dt.timedelta(hours=hour) if hours else None, text, None, flag, 0.5 if text else None,
            T0 + dt.timedelta(days=1, hours=hour), *rest)


LONE = [_row(1, 0, 5.0), _row(1, 1, -0.0, -0.0, "outlier", None), _row(2, 0, 7.5, None, "extreme_solar"), _row(2, 1, None),
        _row(3, 0, 1.0, 271.5), _row(3, 0, 1.0, hours=False)]
PAIR = [_row(1, 3, 5.0, text="sun"), _row(1, 3, 9.0, 3.0), _row(4, 0, 1.0, hours=False), _row(4, 0, 2.0, hours=False)]


def _rows(spark, rows):
    return materialize(spark.createDataFrame(rows, SCHEMA), "rows")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _found(df):
    return sorted(map(str, df.collect()))


def test_lone_rows_equal_the_aggregates_without_a_shuffle(spark):
    rows = _rows(spark, LONE)
    areas = spark.createDataFrame([(i, f"plz{i}") for i in range(1, 5)], "id long, plz string")
    kept = rows.filter("temperature IS NOT NULL")
    for rule in ("faithful", "any"):
        mart = models.mart_weather(rows.drop("plz"), areas, outlier_rule=rule, sort=False)
        whole = kept.groupBy(*GROUP).agg(*models.mart_aggregates(rule)).select(*spec.mart_columns())
        assert _found(mart) == _found(whole) and mart.count() == 5
        assert "partial_avg" not in _plan(mart) and "hashpartitioning(plz" not in _plan(mart)


def test_groups_of_one_and_of_several_rows_together(spark):
    rows = _rows(spark, LONE + PAIR)
    areas = spark.createDataFrame([(i, f"plz{i}") for i in range(1, 5)], "id long, plz string")
    kept = rows.filter("temperature IS NOT NULL")
    lone, several = by_group_size(kept, GROUP)
    assert lone.count() == 5 and several.count() == 4  # rows without an hour are a group as any other
    whole = kept.groupBy(*GROUP).agg(*models.mart_aggregates()).select(*spec.mart_columns())
    assert _found(models.mart_weather(rows.drop("plz"), areas, sort=False)) == _found(whole)
    most = _rows(spark, PAIR + LONE[:1])
    assert by_group_size(most, GROUP)[0] is None  # most groups have several: all go one way
