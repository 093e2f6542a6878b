"""Small helpers the corpus operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_folder

#: The bytes that separate words.
BLANKS = " \t\n\x0b\f\r"
#: The same as a regular expression.
BLANK_RUN = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_or_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, also where ``body`` uses it inside lambdas."""
    return F.transform(F.array(value), body)[0]


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_words(text: Column) -> Column:
    """Maximal runs of bytes other than blanks; none for a blank text."""
    return F.filter(F.split(text, BLANK_RUN), lambda w: w != "")


def written(df: DataFrame, label: str) -> DataFrame:
    """The frame from a table in the folder that all executors share: lineage ends there."""
    spark = df.sparkSession
    folder = work_folder(spark, label)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
