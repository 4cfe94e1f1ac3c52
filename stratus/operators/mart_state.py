"""Mergeable states of the mart's groups: what is kept of a (plz, hour) group so that more rows can be added to it.

Per measure the count, mean and sum of squared deviations, minimum, maximum, sum, and for directions the sums
of sine and cosine; per text column the counts of its values (for the mode); row, outlier and confidence
totals and the newest load stamp. Two states merge pairwise (deviations by the shift of the means, so identical
values keep a deviation of exactly 0); ``finish`` turns states into the mart's columns.

A state's value counts are bounded by the distinct conditions and icons. Groups without a row that has a
temperature have no state. NULL measures are ignored as the aggregates ignore them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratus.functions import spec
from stratus.operators.dedup import by_group_size
from stratus.operators.incremental import tasks_for
from stratus.operators.joins import by_rows
from stratus.session import materialize

GROUP = ["plz", "timestamp_utc"]
TEXTS = tuple(column for _, column in spec.TEXT_FIELDS)
COUNTS = "map<string,bigint>"
_TOTALS = ("rows_n", "outlier_n", "flagged_n", "confidence_n", "confidence_sum")


def _parts(m: spec.Measure) -> list[str]:
    """The parts of a measure's state, by what the mart needs of it."""
    found = ["n", "mean", "m2"] + [a for a in ("min", "max", "sum") if a in m.aggs]
    return found + (["sin", "cos"] if "circavg" in m.aggs else [])


def _text_counts(rows: DataFrame, column: str, by: list[str]) -> DataFrame:
    """Per group the map of the column's values to their numbers; values are counted with partial sums first."""
    counts = rows.filter(F.col(column).isNotNull()).groupBy(*by, column).agg(F.count("*").alias("_n"))
    entries = F.map_from_entries(F.collect_list(F.struct(F.col(column), F.col("_n"))))
    return counts.groupBy(*by).agg(entries.alias(f"{column}_counts"))


def states(rows: DataFrame, by: list[str] = GROUP) -> DataFrame:
    """One state per group of ``rows`` (staged or fact rows with their ``plz``, a written table: it is read several times);
    ``by`` are the group's columns. A row that is alone in its group is its state, without a shuffle."""
    rows = rows.filter(F.col(spec.MART_REQUIRED_MEASURE).isNotNull())
    lone, several = by_group_size(rows, by)
    found = [made for made in (None if lone is None else _lone_states(lone, by),
                               None if several is None else _several_states(several, by)) if made is not None]
    return found[0] if len(found) == 1 else found[0].unionByName(found[1])


def _lone_states(rows: DataFrame, by: list[str]) -> DataFrame:
    """The states of rows that are alone in their groups, as the aggregates would give them."""
    cols: list[Column] = []
    for m in spec.MEASURES:
        c = F.col(m.name)
        # sums and averages start from 0.0, which turns -0.0 to 0.0; a value that is not finite has no deviation of 0
        made = {"n": F.when(c.isNotNull(), 1).otherwise(0).cast("long"), "mean": c + 0.0, "m2": F.coalesce(c - c, F.lit(0.0)),
                "min": c, "max": c, "sum": c + 0.0, "sin": F.sin(F.radians(c)) + 0.0, "cos": F.cos(F.radians(c)) + 0.0}
        cols += [made[part].alias(f"{m.name}_{part}") for part in _parts(m)]
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    cols += [one.alias("rows_n"),
             F.when(F.col("outlier_flag") == F.lit(spec.FAITHFUL_OUTLIER_CODE), one).otherwise(none).alias("outlier_n"),
             F.when(F.col("outlier_flag").isNotNull(), one).otherwise(none).alias("flagged_n"),
             F.when(F.col("confidence_score").isNotNull(), one).otherwise(none).alias("confidence_n"),
             (F.col("confidence_score") + 0.0).alias("confidence_sum"), F.col("load_dts")]
    # a group with a null key has no text counts: where groups are aggregated their counts are joined by these keys
    keyed = reduce(Column.__and__, (F.col(k).isNotNull() for k in by))
    cols += [F.when(keyed & F.col(column).isNotNull(), F.create_map(F.col(column), one)).otherwise(F.create_map().cast(COUNTS))
             .alias(f"{column}_counts") for column in TEXTS]
    return rows.select(*by, *cols)


def _several_states(rows: DataFrame, by: list[str]) -> DataFrame:
    aggs: list[Column] = []
    for m in spec.MEASURES:
        c = F.col(m.name)
        made = {"n": F.count(c), "mean": F.avg(c), "m2": F.coalesce(F.var_pop(c) * F.count(c), F.lit(0.0)), "min": F.min(c),
                "max": F.max(c), "sum": F.sum(c), "sin": F.sum(F.sin(F.radians(c))), "cos": F.sum(F.cos(F.radians(c)))}
        aggs += [made[part].alias(f"{m.name}_{part}") for part in _parts(m)]
    aggs += [F.count("*").alias("rows_n"),
             F.count_if(F.col("outlier_flag") == F.lit(spec.FAITHFUL_OUTLIER_CODE)).alias("outlier_n"),
             F.count("outlier_flag").alias("flagged_n"), F.count("confidence_score").alias("confidence_n"),
             F.sum("confidence_score").alias("confidence_sum"), F.max("load_dts").alias("load_dts")]
    out = rows.groupBy(*by).agg(*aggs)
    for column in TEXTS:
        out = out.join(_text_counts(rows, column, by), by, "left") \
            .withColumn(f"{column}_counts", F.coalesce(f"{column}_counts", F.create_map().cast(COUNTS)))
    return out


def split_zones(zones: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``zones`` (station, plz) of the plz that have one row in them, and those of the others if there are any."""
    per = zones.groupBy("plz").agg(F.count(F.lit(1)).alias("_n"), F.max("wmo_station_id").alias("wmo_station_id"))
    several = per.filter(F.col("_n") > 1).select("plz")
    shared = None if several.isEmpty() else by_rows(zones.join(several, "plz", "left_semi"), zones)
    return per.filter(F.col("_n") == 1).select("wmo_station_id", "plz"), shared


def area_states(rows: DataFrame, sole: DataFrame, shared: DataFrame | None, groups: DataFrame) -> DataFrame:
    """States of ``groups`` (distinct) over staged ``rows``; ``sole`` and ``shared`` as ``split_zones`` gives them.

    Rows are not fanned out to the areas their station serves: its states per hour are made once, and each plz that
    only this station serves takes them over. Rows of several stations are met with the plz they share.
    The rows are written once, as ``states`` reads them once for itself and once for each text, and dealt by their number.
    """
    alone = by_rows(by_rows(groups).join(sole, "plz"), groups)
    hours = ["wmo_station_id", "timestamp_utc"]
    met = materialize(rows.join(alone.select(*hours).distinct(), hours, "left_semi"), "state_rows")
    own = states(met.repartition(tasks_for(met), *hours), hours)
    out = alone.join(own, hours).select(*GROUP, *(c for c in own.columns if c not in hours))
    if shared is None:
        return out
    common = materialize(rows.join(shared, "wmo_station_id").join(by_rows(groups), GROUP, "left_semi"), "shared_rows")
    return out.unionByName(states(common))


def merge(old: DataFrame, new: DataFrame) -> DataFrame:
    """The states of both tables' groups, a group's two states as one."""
    a = old.select(*GROUP, F.struct(*[c for c in old.columns if c not in GROUP]).alias("a"))
    b = new.select(*GROUP, F.struct(*[c for c in new.columns if c not in GROUP]).alias("b"))
    met = a.join(b, GROUP, "full_outer")

    def added(name: str, empty=0) -> Column:
        return F.coalesce(F.col(f"a.{name}"), F.lit(empty)) + F.coalesce(F.col(f"b.{name}"), F.lit(empty))

    cols: list[Column] = []
    for m in spec.MEASURES:
        left, right = F.coalesce(F.col(f"a.{m.name}_n"), F.lit(0)), F.coalesce(F.col(f"b.{m.name}_n"), F.lit(0))
        n, shift = left + right, F.col(f"b.{m.name}_mean") - F.col(f"a.{m.name}_mean")
        both = (left > 0) & (right > 0)
        made = {"n": n,
                "mean": F.when(both, F.col(f"a.{m.name}_mean") + shift * right / n)
                .otherwise(F.coalesce(f"a.{m.name}_mean", f"b.{m.name}_mean")),
                "m2": added(f"{m.name}_m2", 0.0) + F.when(both, shift * shift * left * right / n).otherwise(F.lit(0.0)),
                "min": F.least(f"a.{m.name}_min", f"b.{m.name}_min") if "min" in m.aggs else None,
                "max": F.greatest(f"a.{m.name}_max", f"b.{m.name}_max") if "max" in m.aggs else None,
                "sum": F.when(n > 0, added(f"{m.name}_sum", 0.0)) if "sum" in m.aggs else None,
                "sin": F.when(n > 0, added(f"{m.name}_sin", 0.0)) if m.circular else None,
                "cos": F.when(n > 0, added(f"{m.name}_cos", 0.0)) if m.circular else None}
        cols += [made[part].alias(f"{m.name}_{part}") for part in _parts(m)]
    cols += [added(t, 0.0 if t == "confidence_sum" else 0).alias(t) for t in _TOTALS]
    cols.append(F.greatest("a.load_dts", "b.load_dts").alias("load_dts"))
    none = F.create_map().cast(COUNTS)
    for column in TEXTS:
        both = F.map_zip_with(F.coalesce(F.col(f"a.{column}_counts"), none), F.coalesce(F.col(f"b.{column}_counts"), none),
                              lambda _, x, y: F.coalesce(x, F.lit(0)) + F.coalesce(y, F.lit(0)))
        cols.append(both.alias(f"{column}_counts"))
    return met.select(*GROUP, *cols)


def _mode(counts: Column) -> Column:
    """The most frequent value, of several the smallest."""
    ranked = F.transform(F.map_entries(counts), lambda e: F.struct((-e.value).alias("n"), e.key.alias("v")))
    return F.array_min(ranked).getField("v")


def finish(state: DataFrame, outlier_rule: str = "faithful") -> DataFrame:
    """The mart rows of the states."""
    if outlier_rule not in ("faithful", "any"):
        raise ValueError(outlier_rule)
    cols: list[Column] = []
    for m in spec.MEASURES:
        n = F.col(f"{m.name}_n")
        for a in m.aggs:
            if a == "avg":
                e = F.col(f"{m.name}_mean")
            elif a == "std":
                e = F.when(n > 1, F.sqrt(F.col(f"{m.name}_m2") / (n - 1)))
            elif a == "circavg":
                s, c = (F.try_divide(F.col(f"{m.name}_{part}"), n) for part in ("sin", "cos"))
                theta = F.degrees(F.atan2(s, c))
                e = F.when(s >= 0, theta).otherwise(theta + F.lit(360.0))
            else:
                e = F.col(f"{m.name}_{a}")
            cols.append(e.alias(f"{m.name}_{'avg' if a == 'circavg' else a}"))
    cols += [F.col("rows_n").alias("station_count"),
             (F.col(f"{spec.MART_REQUIRED_MEASURE}_n").cast("double") / F.col("rows_n")).alias("data_completeness"),
             F.col("outlier_n" if outlier_rule == "faithful" else "flagged_n").alias("outlier_count"),
             F.try_divide("confidence_sum", "confidence_n").alias("confidence_score_avg"),
             *(_mode(F.col(f"{column}_counts")).alias(f"{column}_mode") for column in TEXTS),
             F.lit(spec.MART_RECORD_SOURCE).alias("record_source"), F.col("load_dts")]
    return state.select(*GROUP, *cols).select(*spec.mart_columns())
