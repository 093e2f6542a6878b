"""Fact and dimension tables."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import date_key
from .conform import ColumnSpec, conform


def date_dim(df: DataFrame, column: str) -> DataFrame:
    """One row per distinct non-null date. Repeats collapse in each map task before the shuffle."""
    day = F.col("calendar_date")
    return (
        df.select(F.col(column).cast("date").alias("calendar_date"))
        .where(day.isNotNull())
        .distinct()
        .select(
            date_key(day).alias("date_key"),
            day,
            F.year(day).alias("year"),
            F.month(day).alias("month"),
            F.dayofmonth(day).alias("day"),
            F.dayofweek(day).alias("day_of_week"),
        )
    )


def static_dim(spark: SparkSession, rows: Sequence[tuple], schema: Sequence[tuple[str, str]]) -> DataFrame:
    """A small literal relation.

    Built from an Arrow table, which Spark keeps as a local relation of known size: joins may
    broadcast it. A frame made from Python rows counts as infinitely large instead.
    """
    if not rows:
        raise ValueError("at least one row is needed")
    names = [name for name, _ in schema]
    local = pa.Table.from_pylist([dict(zip(names, row, strict=True)) for row in rows])
    return spark.createDataFrame(local).select(*[F.col(n).cast(t).alias(n) for n, t in schema])


def attribute_dim(df: DataFrame, columns: Sequence[ColumnSpec]) -> DataFrame:
    """A dimension projected from a source table by (source, target, type)."""
    return conform(df, columns)


def fact(df: DataFrame, date_column: str, columns: Sequence[str]) -> DataFrame:
    """The listed columns behind an integer key of ``date_column``. Map-only."""
    return df.select(date_key(F.col(date_column)).alias("date_key"), *columns)
