"""Catalog tables and named source relations for SQL models."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


@contextmanager
def declare_sources(spark: SparkSession, relations: Mapping[str, DataFrame]) -> Iterator[None]:
    """Make frames available to SQL text under the given names, inside the block.

    Names the session uses already are refused rather than replaced.
    """
    declared = []
    try:
        for name, frame in relations.items():
            frame.createTempView(name)
            declared.append(name)
        yield
    finally:
        for name in declared:
            spark.catalog.dropTempView(name)


def count_rows(df: DataFrame, name: str = "row_count") -> DataFrame:
    """One-row relation with the number of rows; a parquet scan answers it from its footers."""
    return df.agg(F.count(F.lit(1)).alias(name))
