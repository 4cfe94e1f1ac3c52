"""Latest-version selection: ``ROW_NUMBER() ... = 1`` and ``DISTINCT ON`` re-expressed as one window.

``row_number() = 1`` is planned by Spark as a partial ``WindowGroupLimit`` before the shuffle, so a key
holding a large share of the rows (repeated loads of one station-hour) is cut to one row per map task
before it is exchanged.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def desc_nulls_first(c: str | Column) -> Column:
    """PostgreSQL's ``DESC`` ordering (NULLs first); Spark's ``desc()`` puts NULLs last."""
    col = F.col(c) if isinstance(c, str) else c
    return col.desc_nulls_first()


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Iterable[Column], rn_col: str = "_rn") -> DataFrame:
    """Keep the first row per ``keys`` under ``order`` (pass tie-breakers in ``order`` for determinism)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rn_col, F.row_number().over(w)).filter(F.col(rn_col) == 1).drop(rn_col)


def distinct_on(df: DataFrame, keys: Sequence[str], newest: str = "load_dts",
                tiebreak: Sequence[str] = ()) -> DataFrame:
    """``SELECT DISTINCT ON (keys) * ... ORDER BY keys, newest DESC`` with explicit tie-breakers."""
    order = [desc_nulls_first(newest)] + [F.col(t).asc_nulls_last() for t in tiebreak]
    return latest_per_key(df, keys, order)


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_col: str = "record_count") -> DataFrame:
    """Groups holding more than one row (``GROUP BY keys HAVING count(*) > 1``); partial counts pre-aggregate."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col)).filter(F.col(count_col) > 1)


def by_group_size(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame | None, DataFrame | None]:
    """Rows of ``df`` (a written table: it is read several times) that are alone in their group, and those of larger groups; None
    where there are none. An aggregate over one row is the row, so only the others need one. Where most groups have
    several rows, all are given as such: to part them would cost more than it saves. Null keys are a group."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))
    found = sizes.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_size") > 1).alias("several")).first()
    if found["several"] == 0:
        return df, None
    if 2 * found["several"] > found["n"]:
        return None, df
    large = sizes.filter(F.col("_size") > 1).select(*(F.col(k).alias(f"_{i}") for i, k in enumerate(keys)))
    same = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"_{i}")) for i, k in enumerate(keys)))
    return df.join(large, same, "left_anti"), df.join(large, same, "left_semi")
