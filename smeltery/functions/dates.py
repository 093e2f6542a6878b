"""Date keys and durations that do not depend on the session time zone for zone-less columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def date_key(day: Column) -> Column:
    """2023-01-31 as the integer 20230131, without going through a string."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def epoch_seconds(moment: Column, dtype: T.DataType) -> Column:
    """Whole seconds since 1970, sub-seconds dropped."""
    if isinstance(dtype, T.TimestampNTZType):
        # A zone-less value has no epoch cast; take it as UTC, whatever the session zone is.
        days = F.date_diff(F.to_date(moment), F.lit("1970-01-01").cast("date")).cast("bigint")
        return days * 86400 + F.hour(moment) * 3600 + F.minute(moment) * 60 + F.second(moment)
    return F.unix_seconds(moment.cast("timestamp"))


def minutes_between(start: Column, end: Column, start_type: T.DataType, end_type: T.DataType):
    """Fractional minutes from ``start`` to ``end``."""
    return (epoch_seconds(end, end_type) - epoch_seconds(start, start_type)) / F.lit(60.0)
