"""Parquet landed by period, one file or folder per period, with types that drift over time."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.conform import ColumnSpec, conform, union_conformed
from .inventory import exact, footer, inventoried, is_file, landed_files, with_columns

# Fixed value: how landed files are named.
_LANDED_FILE = "{dataset}/{dataset}_tripdata_{period}.parquet"

# Plain files up to this number are looked at by the driver, which takes less than a job would.
_NAMED = 16


def period_path(root: str, dataset: str, period: str) -> str:
    """Landing path of one dataset and period such as ``2023-01``."""
    return f"{root.rstrip('/')}/{_LANDED_FILE.format(dataset=dataset, period=period)}"


def list_files(spark: SparkSession, paths: Sequence[str], name_pattern: str = "*.parquet") -> list[str]:
    """The names of ``landed_files``, in order."""
    return sorted(r.path for r in landed_files(spark, paths, name_pattern).select("path").collect())


def list_periods(spark: SparkSession, root: str, dataset: str | None = None) -> list[str]:
    """The landed files below ``root``; with ``dataset``, only those in its folder. Each is a period of its own."""
    return list_files(spark, [root if dataset is None else f"{root.rstrip('/')}/{dataset}"])


def read_period(spark: SparkSession, path: str, columns: Sequence[ColumnSpec]) -> DataFrame:
    """One period, conformed."""
    return conform(spark.read.parquet(exact(path)), columns)


def _needed(schema: T.StructType, names: Sequence[str], path: str, fold: Callable) -> T.StructType:
    found = {fold(f.name): f for f in schema}
    missing = [n for n in names if fold(n) not in found]
    if missing:
        raise ValueError(f"{path} lacks the columns {missing}")
    return T.StructType([T.StructField(n, found[fold(n)].dataType) for n in names])


def _alike(spark: SparkSession, paths: Sequence[str], inventory: str | None) -> list[list[str]]:
    """The files at or below the paths, those that store the same put together."""
    if inventory is None and len(paths) <= _NAMED and all(map(is_file, paths)):
        stored = [(path, footer(path)) for path in paths]
        groups: dict[str, list[str]] = {}
        for path, columns in stored:
            groups.setdefault(columns or path, []).append(path)
        return list(groups.values())
    files = with_columns(landed_files(spark, paths)) if inventory is None else inventoried(spark, paths, inventory)
    # A file only Spark can open makes a group of its own, and Spark reads its footer.
    kind = F.coalesce("columns", "path")
    found = files.select("path", F.sha2(kind, 256).alias("kind")).collect()
    groups = {}
    for path, key in found:
        groups.setdefault(key, []).append(path)
    return list(groups.values())


def read_periods(
    spark: SparkSession, paths: Sequence[str], columns: Sequence[ColumnSpec], inventory: str | None = None
) -> DataFrame:
    """All periods, conformed and put together. Paths are exact, files or folders.

    One scan cannot span files whose types differ, and one scan per period makes a plan as wide as
    the list is long. So the footer of every file is read, all in one job, and files are grouped by
    what they store: one scan per distinct set of types, usually a handful. A file that lacks a column is
    an error that names it. With ``inventory``, a folder that remembers, only unknown files have their footers read.
    The driver gets what the scans need, each path with a digest of what it stores; a short list of plain
    files is looked at without any job.
    """
    if not paths:
        raise ValueError("nothing to read: the list of periods is empty")
    names = list(dict.fromkeys(c[0] for c in columns))
    fold = str if spark.conf.get("spark.sql.caseSensitive") == "true" else str.lower
    alike = _alike(spark, paths, inventory)
    if not alike:
        raise ValueError(f"no parquet files in {list(paths)[:3]}")
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for members in alike:
        first = min(members)
        schema = _needed(spark.read.parquet(exact(first)).schema, names, first, fold)
        groups.setdefault(schema.simpleString(), (schema, []))[1].extend(members)
    return union_conformed(
        conform(spark.read.schema(schema).parquet(*[exact(m) for m in sorted(members)]), columns)
        for schema, members in groups.values()
    )
