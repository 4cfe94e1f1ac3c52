"""Join helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000


def fits(rows: int) -> bool:
    """May the driver hold so many rows, to broadcast them?"""
    return rows <= BROADCAST_ROWS


def few_rows(df: DataFrame) -> bool:
    """Of a written table, whose footers are counted."""
    return fits(df.count())


def by_rows(side: DataFrame, of: DataFrame | None = None) -> DataFrame:
    """``side`` of a join, kept from being broadcast if ``of`` (a written table that bounds its rows; ``side`` itself) has more
    than ``BROADCAST_ROWS``. Spark goes by the packed bytes of a written table: a row of keys packs to 3 bytes and
    takes over 100 in the driver, which builds what it broadcasts."""
    return side if few_rows(side if of is None else of) else side.hint("merge")


def anti_check(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str | None = None) -> DataFrame:
    """Rows of ``child`` whose key has no match in ``parent`` (``LEFT JOIN ... WHERE parent.key IS NULL``).

    NULL child keys are reported too, as in the LEFT JOIN form.
    """
    pk = parent_key or child_key
    keys = parent.select(F.col(pk).alias("_pk")).filter(F.col("_pk").isNotNull())
    return child.join(keys, F.col(child_key) == F.col("_pk"), "left_anti")
