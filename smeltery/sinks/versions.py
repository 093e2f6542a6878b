"""Versioned tables: each publish writes a new folder, then a log row makes it current.

Readers resolve a table through the log, so they see the old version until the commit and a job
that dies midway leaves it in place. One writer per store is assumed.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import listing_folders
from .tables import create_at, details, ensure_namespace, partitioned_writer

_LOG_SCHEMA = (
    "table_name string, version int, committed_at timestamp, row_count bigint, "
    "path string, schema_json string"
)
_PARTITION = "smeltery.partition"
_VIEWS_SCHEMA = "table_name string, view string"


class Staged(NamedTuple):
    """A written version that readers do not see yet."""

    table: str
    version: int
    path: str
    frame: DataFrame
    partition_by: Sequence[str] = ()


def _log_path(root: str) -> str:
    return f"{root.rstrip('/')}/commits"


def _log(spark: SparkSession, root: str) -> DataFrame:
    try:
        return spark.read.schema(_LOG_SCHEMA).parquet(_log_path(root))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        fields = T.StructType.fromDDL(_LOG_SCHEMA)
        return spark.range(0).select([F.lit(None).cast(f.dataType).alias(f.name) for f in fields])


def _open(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    with listing_folders(spark):
        return spark.read.schema(schema).parquet(path)


def history(spark: SparkSession, root: str, table: str | None = None) -> DataFrame:
    """One row per publish: table, version, time, rows and path."""
    log = _log(spark, root).drop("schema_json")
    return log.where(F.col("table_name") == table) if table else log


def stage(
    df: DataFrame, root: str, table: str, partition_by: Sequence[str] = (), shuffle: bool = True
) -> Staged:
    """Write the next version without making it current. A rerun after a failure writes over it.

    ``shuffle=False`` keeps the layout ``df`` has, see ``partitioned_writer``.
    """
    spark = df.sparkSession
    latest = _log(spark, root).where(F.col("table_name") == table).agg(F.max("version")).first()[0]
    version = (latest or 0) + 1
    path = f"{root.rstrip('/')}/{table}/version-{version:06d}"
    with partitioned_writer(df, partition_by, shuffle) as out:
        # Whatever the session says: a rerun must not keep partitions that a failed run left.
        out.option("partitionOverwriteMode", "static").partitionBy(*partition_by).mode("overwrite").save(path)
    # A relation read from files can hold NULL anywhere, and partition columns come last.
    fields = [f for f in df.schema if f.name not in partition_by]
    fields += [df.schema[name] for name in partition_by]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields])
    return Staged(table, version, path, _open(spark, path, schema).select(df.columns), tuple(partition_by))


def _logged_schema(staged: Staged) -> str:
    """The schema, partition columns marked with their place."""
    place = {name: {_PARTITION: i} for i, name in enumerate(staged.partition_by)}
    fields = [T.StructField(f.name, f.dataType, True, place.get(f.name)) for f in staged.frame.schema]
    return T.StructType(fields).json()


def commit(spark: SparkSession, root: str, *staged: Staged) -> None:
    """Make all staged versions current with one write to the log."""
    rows = [
        s.frame.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(s.table).alias("table_name"),
            F.lit(s.version).alias("version"),
            F.current_timestamp().alias("committed_at"),
            "row_count",
            F.lit(s.path).alias("path"),
            F.lit(_logged_schema(s)).alias("schema_json"),
        )
        for s in staged
    ]
    # A single file, so the versions become visible together.
    reduce(DataFrame.unionByName, rows).coalesce(1).write.mode("append").parquet(_log_path(root))
    renew_views(spark, root, [s.table for s in staged])


def publish(df: DataFrame, root: str, table: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write the next version and make it current."""
    staged = stage(df, root, table, partition_by)
    commit(df.sparkSession, root, staged)
    return staged.frame


def _resolve(
    spark: SparkSession,
    root: str,
    table: str,
    version: int | None = None,
    as_of: datetime | None = None,
) -> tuple[str, T.StructType]:
    rows = _log(spark, root).where(F.col("table_name") == table)
    if version is not None:
        rows = rows.where(F.col("version") == version)
    if as_of is not None:
        rows = rows.where(F.col("committed_at") <= F.lit(as_of))
    row = rows.orderBy(F.desc("version")).first()
    if row is None:
        wanted = version if version is not None else as_of
        raise ValueError(f"{table} has no version" + (f" {wanted}" if wanted is not None else ""))
    return row.path, T.StructType.fromJson(json.loads(row.schema_json))


def read_version(
    spark: SparkSession,
    root: str,
    table: str,
    version: int | None = None,
    as_of: datetime | None = None,
) -> DataFrame:
    """The current version of a table, a numbered one, or the one current at a moment."""
    path, schema = _resolve(spark, root, table, version, as_of)
    return _open(spark, path, schema).select(schema.names)


def _view_namespace(spark: SparkSession, view: str) -> None:
    if "." in view:
        ensure_namespace(spark, view.rsplit(".", 1)[0])


def _show(spark: SparkSession, root: str, table: str, view: str) -> None:
    """Point a view at the current version, through a table with the types of the log.

    A scan of files would guess the types of partition columns from their folder names. The view changes by
    one step of the catalog, and then the tables it no longer needs go; their files belong to the store and stay.
    """
    path, schema = _resolve(spark, root, table)
    under = f"{view}_v{path.rsplit('-', 1)[1]}"
    marked = sorted((f.metadata[_PARTITION], f.name) for f in schema if _PARTITION in f.metadata)
    spark.sql(f"DROP TABLE IF EXISTS {under}")  # its name, not its files
    create_at(spark, under, schema, [name for _, name in marked], path)
    picked = ", ".join(f"`{f.name}`" for f in schema)
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {picked} FROM {under}")
    space, _, short = view.rpartition(".")
    for other in spark.catalog.listTables(space or None, f"{short}_v*"):
        named = f"{space}.{other.name}" if space else other.name
        earlier = re.fullmatch(re.escape(short.lower()) + r"_v\d{6,}", other.name.lower())
        if earlier and named.lower() != under.lower() and f"/{table}/version-" in details(spark, named).get("Location", ""):
            spark.sql(f"DROP TABLE IF EXISTS {named}")


def _views_path(root: str) -> str:
    return f"{root.rstrip('/')}/views"


def expose(
    spark: SparkSession, root: str, tables: Mapping[str, str], log_view: str | None = None
) -> None:
    """Catalog views (``namespace.table``) on the current versions, for ad-hoc SQL.

    The store remembers its views, and a commit in a session whose catalog has them moves them along: a
    name shows the current version. ``log_view`` names a view on the history of all tables. Views outlive
    the session if the catalog does.
    """
    for table, view in tables.items():
        _view_namespace(spark, view)
        _show(spark, root, table, view)
    known = spark.createDataFrame(list(tables.items()), _VIEWS_SCHEMA)
    known.coalesce(1).write.mode("append").parquet(_views_path(root))
    if log_view:
        _view_namespace(spark, log_view)
        picked = ", ".join(history(spark, root).columns)
        spark.sql(f"CREATE OR REPLACE VIEW {log_view} AS SELECT {picked} FROM parquet.`{_log_path(root)}`")


def renew_views(spark: SparkSession, root: str, tables: Sequence[str]) -> None:
    """Point the store's views on these tables at the current versions, if this catalog has them."""
    try:
        views = spark.read.schema(_VIEWS_SCHEMA).parquet(_views_path(root)).distinct()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return
    for row in views.where(F.col("table_name").isin(*tables)).collect():
        if spark.catalog.tableExists(row["view"]):
            _show(spark, root, row["table_name"], row["view"])
