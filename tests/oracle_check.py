"""Compare registered queries with DuckDB: names, types, row counts and every value."""

from __future__ import annotations

import os
import sys
import tempfile
import time
from collections import Counter

import duckdb
from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

# DuckDB types a Spark type may stand for.
TYPES = {
    "int": {"INTEGER"},
    "bigint": {"BIGINT"},
    "double": {"DOUBLE"},
    "string": {"VARCHAR"},
    "date": {"DATE"},
    "timestamp_ntz": {"TIMESTAMP"},
    "boolean": {"BOOLEAN"},
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def differences(con: duckdb.DuckDBPyConnection, sql: str, df: DataFrame) -> list[str]:
    relation = con.sql(sql)
    expected_types = dict(zip(relation.columns, map(str, relation.types)))
    actual_types = dict(df.dtypes)
    names = sorted(actual_types)
    if names != sorted(expected_types):
        return [f"columns {names} against {sorted(expected_types)}"]
    found = [
        f"{n}: {actual_types[n]} against {expected_types[n]}"
        for n in names
        if expected_types[n] not in TYPES.get(actual_types[n], set())
    ]
    quoted = ", ".join(f'"{n}"' for n in names)
    expected = Counter(con.sql(f"SELECT {quoted} FROM ({sql})").fetchall())
    actual = Counter(tuple(r) for r in df.select(*names).collect())
    if expected != actual:
        found.append(
            f"{sum(actual.values())} rows against {sum(expected.values())}; "
            f"only here {list((actual - expected).items())[:2]}; "
            f"only there {list((expected - actual).items())[:2]}"
        )
    return found


def main() -> int:
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    sys.path.insert(0, root)
    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="smeltery-warehouse-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    sqls = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            found = differences(con, sqls[name], query(spark, sf_dir))
        except Exception as error:  # report and go on with the other queries
            found = [f"{type(error).__name__}: {str(error)[:1500]}"]
        bad += bool(found)
        print(f"{'DIFF' if found else 'ok  '} {name} {time.time() - start:.2f}s", *found, sep="\n     ")
    print(f"{bad} queries differ")
    return bad


if __name__ == "__main__":
    sys.exit(main())
