"""Catalog tables: full replace, partition replace, SQL models.

Each replacement is written to a fresh folder and becomes current by a change of location in the catalog. No
data is moved, copied or renamed, which on an object store would mean copying it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import listing_folders, overriding

_COALESCE = "spark.sql.adaptive.coalescePartitions.enabled"
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # fixed value: the folder of NULL
# Partitions added or dropped by one statement, and statements at a time where each partition needs its own.
_PER_STATEMENT = 500
_AT_A_TIME = 8


def ensure_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create a namespace unless it exists; ``location`` is a shared folder for its tables."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {name}{place}")


@contextmanager
def partitioned_writer(
    df: DataFrame, partition_by: Sequence[str], shuffle: bool = True
) -> Iterator[DataFrameWriter]:
    """A parquet writer that brings the rows of a partition value together first.

    A plain repartition would hand a hot date to one task. The rebalance hint lets adaptive
    execution split such a date by size. Merging small shuffle partitions is turned off meanwhile:
    a date lands in one file either way, and merged tasks would only write them one by one.

    A date that hashes to the same shuffle partition as a hot one is split with it into more files.
    Many more shuffle partitions than dates make that rare.

    ``shuffle=False`` is for rows that lie together already, as when they are read from a table
    partitioned alike: each task then writes the few dates it read, and nothing is exchanged.
    """
    spark = df.sparkSession
    if not partition_by:
        yield df.write.format("parquet")
        return
    with overriding(spark, {_COALESCE: "false"}), listing_folders(spark):
        yield (df.hint("rebalance", *partition_by) if shuffle else df).write.format("parquet")


def quoted(text: str) -> str:
    """A string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _identifier(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def _spec(fragment: str) -> str:
    """The partition of a folder such as ``a=1/b=x%20y``, as SQL."""
    values = []
    for part in fragment.split("/"):
        column, value = part.split("=", 1)
        value = unquote(value)
        values.append(f"{_identifier(unquote(column))} = {'NULL' if value == _NO_VALUE else quoted(value)}")
    return f"PARTITION ({', '.join(values)})"


def partition_folders(spark: SparkSession, folder: str, depth: int) -> dict[str, str]:
    """The partitions written below a folder: their place, for each ``a=1/b=2``. Names only, files stay unread."""
    with listing_folders(spark):
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.parquet")
            .load(folder)
        )
        found = files.select(F.regexp_replace("path", "/[^/]*$", "").alias("place")).distinct().collect()
    return {"/".join(r.place.split("/")[-depth:]): r.place for r in found}


def add_partitions(spark: SparkSession, name: str, folders: Mapping[str, str]) -> None:
    """Make partitions known to the catalog, many by one statement."""
    specs = [f"{_spec(f)} LOCATION {quoted(place)}" for f, place in sorted(folders.items())]
    for begin in range(0, len(specs), _PER_STATEMENT):
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(specs[begin : begin + _PER_STATEMENT])}")


def create_at(
    spark: SparkSession, name: str, schema: T.StructType, partition_by: Sequence[str], folder: str
) -> None:
    """A table over the files of a folder, all its partitions known."""
    fields = [f for f in schema if f.name not in partition_by] + [schema[c] for c in partition_by]
    columns = T.StructType([T.StructField(f.name, f.dataType) for f in fields]).toDDL()
    by = f" PARTITIONED BY ({', '.join(map(_identifier, partition_by))})" if partition_by else ""
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet{by} LOCATION {quoted(folder)}")
    if partition_by:
        add_partitions(spark, name, partition_folders(spark, folder, len(partition_by)))


def _known_partitions(spark: SparkSession, name: str) -> set[str]:
    return {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}


def _switch_partitions(spark: SparkSession, name: str, folders: Mapping[str, str], known: set[str]) -> None:
    """Point each partition at its new folder, one change in the catalog each: whatever happens, it is old or new."""

    def switch(fragment: str) -> None:
        spark.sql(f"ALTER TABLE {name} {_spec(fragment)} SET LOCATION {quoted(folders[fragment])}")

    with ThreadPoolExecutor(_AT_A_TIME) as pool:
        list(pool.map(switch, sorted(known & folders.keys())))
    add_partitions(spark, name, {f: place for f, place in folders.items() if f not in known})


class _Folders:
    """The folders of one table's replacements, numbered: ``000001-whole``, ``000002-part``."""

    def __init__(self, spark: SparkSession, name: str):
        space, _, table = name.rpartition(".")
        space = space or spark.catalog.currentDatabase()
        self._base = f"{spark.catalog.getDatabase(space).locationUri.rstrip('/')}/{table.strip('`')}__data"
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._store = self._path(self._base).getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self) -> list[str]:
        base = self._path(self._base)
        return sorted(s.getPath().getName() for s in self._store.listStatus(base)) if self._store.exists(base) else []

    def fresh(self, kind: str) -> str:
        last = max((int(n.split("-")[0]) for n in self._names()), default=0)
        return f"{self._base}/{last + 1:06d}-{kind}"

    def forget_before(self, folder: str) -> None:
        """Delete what is older than a folder of this table."""
        base, _, kept = folder.rpartition("/")
        if base.rpartition("/")[2] != self._base.rpartition("/")[2]:
            return
        for name in self._names():
            if name < kept:
                self._store.delete(self._path(f"{self._base}/{name}"), True)


def _shape(schema: T.StructType, partition_by: Sequence[str]) -> tuple:
    fields = [f for f in schema if f.name not in partition_by] + [schema[c] for c in partition_by]
    return [(f.name, f.dataType) for f in fields], list(partition_by)


def details(spark: SparkSession, name: str) -> dict[str, str]:
    """What the catalog says of a table: Type, Location and more."""
    rows = [(r[0], r[1]) for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()]
    begin = [k for k, _ in rows].index("# Detailed Table Information")
    return dict(rows[begin:])


def _partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def replace_table(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> None:
    """Create the table or replace it whole; running it again gives the same table.

    The successor is written to a fresh folder, and then the table's location changes. The name is never absent, and a job that
    dies while it writes leaves the table as it was. Of a partitioned table each partition changes place by itself; a
    job that dies between them leaves every partition old or new, and the next run completes the change. The folder that
    was current stays for its readers until the next replacement.

    A table of other columns or partitions, or one that keeps its files in the warehouse, is made anew beside the old one, and they
    change names. Only then is there a moment without the name; a job that dies in it is mended by the next run.
    """
    spark = df.sparkSession
    new, old = f"{name}__new", f"{name}__old"
    if not spark.catalog.tableExists(name) and spark.catalog.tableExists(old):
        spark.sql(f"ALTER TABLE {old} RENAME TO {name}")
    folders = _Folders(spark, name)
    folder = folders.fresh("whole")
    with partitioned_writer(df, partition_by) as out:
        out.partitionBy(*partition_by).mode("overwrite").save(folder)
    exists = spark.catalog.tableExists(name)
    live = details(spark, name) if exists else {}
    if exists and live["Type"] == "EXTERNAL" and _shape(df.schema, partition_by) == _shape(
        spark.table(name).schema, _partition_columns(spark, name)
    ):
        if partition_by:
            found, known = partition_folders(spark, folder, len(partition_by)), _known_partitions(spark, name)
            _switch_partitions(spark, name, found, known)
            gone = sorted(known - found.keys())
            for begin in range(0, len(gone), _PER_STATEMENT):
                specs = ", ".join(map(_spec, gone[begin : begin + _PER_STATEMENT]))
                spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {specs}")
        spark.sql(f"ALTER TABLE {name} SET LOCATION {quoted(folder)}")
        spark.catalog.refreshTable(name)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {new}")
        spark.sql(f"DROP TABLE IF EXISTS {old}")
        create_at(spark, new, df.schema, partition_by, folder)
        if exists:
            spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
        spark.sql(f"ALTER TABLE {new} RENAME TO {name}")
        spark.sql(f"DROP TABLE IF EXISTS {old}")
    if exists:
        folders.forget_before(live["Location"])


def replace_partitions(
    df: DataFrame, name: str, audit: Callable[[DataFrame], object] | None = None
) -> None:
    """Replace only the partitions that occur in ``df``; the others stay. For backfills.

    The partitions are written to a fresh folder, ``audit`` may look at what was written and raise, and then each changes
    place in the catalog. A job that dies midway leaves every partition old or new, and running it again completes the change.
    """
    spark = df.sparkSession
    partition_by = _partition_columns(spark, name)
    if not partition_by:
        raise ValueError(f"{name} is not partitioned")
    schema = spark.table(name).schema
    folder = _Folders(spark, name).fresh("part")
    cast = df.select(*[F.col(_identifier(f.name)).cast(f.dataType).alias(f.name) for f in schema])
    with partitioned_writer(cast, partition_by) as out:
        out.partitionBy(*partition_by).mode("overwrite").save(folder)
    if audit:
        with listing_folders(spark):
            audit(spark.read.schema(schema).parquet(folder))
    found = partition_folders(spark, folder, len(partition_by))
    _switch_partitions(spark, name, found, _known_partitions(spark, name))
    spark.catalog.refreshTable(name)


def materialise(
    spark: SparkSession, model: str | DataFrame, name: str, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Run a SQL model, or take a frame, and store the result as a table."""
    replace_table(spark.sql(model) if isinstance(model, str) else model, name, partition_by)
    return spark.table(name)
