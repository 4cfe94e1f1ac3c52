"""Session-time-zone-independent time helpers on TIMESTAMP_NTZ columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hour_floor(ts: Column | str) -> Column:
    """Truncate a TIMESTAMP_NTZ to the hour and stay NTZ (``date_trunc`` would return a session-zoned timestamp)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.lit(0), F.lit(0))


def ntz(literal: str) -> Column:
    """A TIMESTAMP_NTZ literal."""
    return F.lit(literal).cast("timestamp_ntz")


def seconds_between(later: Column, earlier: Column) -> Column:
    """Seconds between two NTZ timestamps as a double (wall-clock difference, no zone involved)."""
    return F.timestamp_diff("MICROSECOND", earlier, later) / F.lit(1e6)
