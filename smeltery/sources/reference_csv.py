"""Reference data in CSV with a header line."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_csv_strings(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Every column as a string. With ``columns`` the header must hold exactly those, in order;
    without, the names come from the header."""
    reader = spark.read.option("header", True)
    if columns:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        reader = reader.schema(schema).option("enforceSchema", False)
    return reader.csv(path)
