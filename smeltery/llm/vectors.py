"""What the operators on vectors share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def finite(vector: str):
    """Whether a vector is there and all its entries are finite numbers. An empty vector is."""
    return F.coalesce(F.forall(vector, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float("inf"))), F.lit(False))


def whole(vector: str, scale: int, add: int = 0):
    """Each entry, as a double, times ``scale``, rounded down, plus ``add``."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(scale))) + F.lit(add).cast("bigint"))


def common_length(vectors: DataFrame, vector: str) -> tuple[int, int, int]:
    """The length most vectors have, the longer one of two as frequent; how many have it; their largest absolute entry.

    ``vectors`` holds whole numbers. Empty vectors don't count. All zero without any vector.
    """
    largest = F.greatest(F.abs(F.array_max(vector)), F.abs(F.array_min(vector)))
    by_length = (
        vectors.select(F.size(vector).alias("length"), largest.alias("entry"))
        .where("length > 0")
        .groupBy("length")
        .agg(F.count("*").alias("n"), F.max("entry").alias("entry"))
    )
    found = by_length.orderBy(F.desc("n"), F.desc("length")).first()
    return (found["length"], found["n"], found["entry"]) if found else (0, 0, 0)


def matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Lists of one length as the rows of an array."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
