"""Incremental ingest: every landed file is taken exactly once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.conform import ColumnSpec, stamp_ingested
from ..sources.inventory import exact, landed_files
from ..sources.periods import read_periods

_BATCH = "ingest_batch"
_TAKEN = f"path string, {_BATCH} bigint"


def _taken(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Path and batch of every file taken so far."""
    try:
        return spark.read.schema(_TAKEN).parquet(exact(f"{checkpoint}/taken"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _TAKEN)


def ingest_new_files(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    columns: Sequence[ColumnSpec],
    max_files_per_batch: int = 1000,
    stamp: bool = True,
    dataset: str | None = None,
) -> None:
    """Conform the files that landed below ``source`` since the last run and add them to ``target``.

    With ``dataset`` only files in its folder below ``source`` count; others stay where they are.

    The files taken are a table below ``checkpoint``, and new ones are what an anti join leaves of the listing,
    however late they land: the driver holds the names of one batch, not of all files ever taken. (Spark's listing
    itself passes through the driver and is let go with the run.) A file counts by its name: one that is
    changed after it was taken is not taken again.

    A batch is read with the period reader, so files of differing types can share it. Its rows go to a folder of its
    own, and a row for each file into the table ends it, with one write. A batch that fails in between was not
    taken: the next run chooses its files anew, and writes over its folder. A batch with a file that lacks a column fails,
    naming it, and nothing of the batch is taken until the file is mended or moved. One run at a time.
    """
    if max_files_per_batch < 1:
        raise ValueError("a batch needs room for a file")
    folder = source if dataset is None else f"{source.rstrip('/')}/{dataset}"
    files = landed_files(spark, [folder])
    while True:
        taken = _taken(spark, checkpoint)
        new = files.join(taken, "path", "left_anti").orderBy("modified_at", "path").limit(max_files_per_batch)
        paths = [row.path for row in new.select("path").collect()]
        if not paths:
            return
        last = taken.agg(F.max(_BATCH)).first()[0]
        batch = 0 if last is None else last + 1
        rows = read_periods(spark, paths, columns)
        rows = stamp_ingested(rows) if stamp else rows
        rows.write.mode("overwrite").parquet(f"{target}/{_BATCH}={batch}")
        spark.createDataFrame([(p, batch) for p in paths], _TAKEN).coalesce(1).write.mode("append").parquet(
            f"{checkpoint}/taken"
        )


def read_ingested(
    spark: SparkSession, target: str, columns: Sequence[ColumnSpec] | None = None
) -> DataFrame:
    """Everything ingested so far. Before the first batch nothing says what columns there are: give them."""
    try:
        return spark.read.parquet(exact(target)).drop(_BATCH)
    except AnalysisException as error:
        if columns is None or error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        fields = ", ".join(f"`{c[-2]}` {c[-1]}" for c in columns)
        return spark.createDataFrame([], fields)
