"""What landed files store: path, size, time and stored columns, each footer read once.

The inventory is a folder of Parquet. Each update lists the landed files, leaves out by an anti join those
it knows with the same size and time, reads the footers of the rest in Spark tasks, and appends a row for each.
Nothing comes to the driver but what Spark's own listing holds while it lasts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from urllib.parse import quote

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STORED = "path string, modified_at timestamp, bytes bigint, columns string"
_NAMES = ["path", "modified_at", "bytes", "columns"]


def exact(path: str) -> str:
    """The path with its glob characters escaped: Spark reads paths as patterns."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def landed_files(spark: SparkSession, paths: Sequence[str], name_pattern: str = "*.parquet") -> DataFrame:
    """The parquet files at or below the paths, with time and size. Lists names only, file contents stay unread."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", name_pattern)
        .load([exact(p) for p in paths])
    )
    return files.select("path", F.col("modificationTime").alias("modified_at"), F.col("length").alias("bytes"))


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(quote(path if ":" in path else f"file://{path}", safe="/:"))


def footer(path: str) -> str | None:
    """The columns of one file and their stored types as text; None where only Spark can open it."""
    try:
        store, place = _opened(path)
        with store.open_input_file(place) as file:
            return pq.read_schema(file).remove_metadata().to_string(show_field_metadata=False)
    except (OSError, ValueError, NotImplementedError):
        return None


def is_file(path: str) -> bool:
    """A single parquet file by name, one that Arrow can reach."""
    try:
        store, place = _opened(path)
        return path.endswith(".parquet") and store.get_file_info(place).type == fs.FileType.File
    except (OSError, ValueError, NotImplementedError):
        return False


def with_columns(files: DataFrame) -> DataFrame:
    """``landed_files`` and what each of them stores, read by the tasks."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([footer(path) for path in batch.column(0).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], _NAMES)

    # The listing is cut by the size of files, which says nothing about the work of reading a footer.
    tasks = files.sparkSession.sparkContext.defaultParallelism
    return files.repartition(tasks, "path").mapInArrow(read, STORED)


def read_inventory(spark: SparkSession, folder: str) -> DataFrame:
    """All the inventory knows, files that changed since or are gone included."""
    try:
        return spark.read.schema(STORED).parquet(exact(folder))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], STORED)


def inventoried(spark: SparkSession, paths: Sequence[str], folder: str) -> DataFrame:
    """The files at or below the paths with what they store; footers are read of unknown files only.

    A file is known when path, size and time are. A run that is repeated, or two at once, may note a file
    twice; it comes back once. One that only Spark can open is not noted, as nothing is known of it.
    """
    files = landed_files(spark, paths)
    same = ["path", "modified_at", "bytes"]
    unknown = files.join(read_inventory(spark, folder), same, "left_anti")
    if not unknown.isEmpty():
        with_columns(unknown).where("columns IS NOT NULL").write.mode("append").parquet(folder)
    return files.join(read_inventory(spark, folder).dropDuplicates(same), same, "left").select(_NAMES)
