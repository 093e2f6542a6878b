"""Data quality checks, evaluated together and reported as rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import any_null, negative


class QualityGateError(Exception):
    """Raised by ``gate`` with every failed check."""

    def __init__(self, failures: list[str]):
        super().__init__("; ".join(failures))
        self.failures = failures


class Check(NamedTuple):
    kind: str
    columns: tuple[str, ...] = ()
    dim: DataFrame | None = None
    dim_key: str | None = None


def non_empty() -> Check:
    return Check("non_empty")


def no_nulls(*columns: str) -> Check:
    """Counts rows with a NULL in any of the columns."""
    if not columns:
        raise ValueError("no_nulls needs at least one column")
    return Check("no_nulls", columns)


def non_negative(*columns: str) -> Check:
    """One result per column."""
    if not columns:
        raise ValueError("non_negative needs at least one column")
    return Check("non_negative", columns)


def references(fact_key: str, dim: DataFrame, dim_key: str) -> Check:
    """Counts rows whose key is not in ``dim``; a NULL key is not in it."""
    return Check("references", (fact_key,), dim, dim_key)


def unique(*columns: str) -> Check:
    """Counts repeated keys; keys with a NULL are ignored."""
    if not columns:
        raise ValueError("unique needs at least one column")
    return Check("unique", columns)


def orphans(fact: DataFrame, dim: DataFrame, keys: Sequence[tuple[str, str]]) -> DataFrame:
    """Keys of ``fact`` without a partner in ``dim``, with their number of rows.

    ``keys`` pairs fact and dim columns. The fact is counted per key, so the anti join with a large
    dimension sees each key once, whatever share of the rows one key holds. If the dimension is
    small enough to broadcast, Spark drops the matching rows in the map tasks before counting.
    """
    counted = fact.groupBy(*[F.col(f).alias(f) for f, _ in keys]).agg(
        F.count(F.lit(1)).alias("orphan_rows")
    )
    side = dim.select(*[F.col(d).alias(f"_dim{i}") for i, (_, d) in enumerate(keys)])
    tests = [F.col(f) == F.col(f"_dim{i}") for i, (f, _) in enumerate(keys)]
    return counted.join(side, reduce(Column.__and__, tests), "left_anti")


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows; keys with a NULL are ignored."""
    return (
        df.where(~any_null(keys))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("key_rows"))
        .where("key_rows > 1")
    )


def _result(table: str, check: str, columns: str, violations: Column) -> Column:
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(check).alias("check_name"),
        F.lit(columns).alias("column_name"),
        violations.alias("violations"),
        (violations == 0).alias("passed"),
    )


def audit(table: str, df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Report of all checks on one table, a row per check and violated unit.

    All row-level and reference checks share one scan: the table is counted by each foreign key and as a whole, by
    grouping sets, and keys that a dimension knows are dropped from the counts, never from rows. Each
    uniqueness check is one more grouped count that reads its key columns only, and so is a second
    reference of the same column.
    """
    if not checks:
        raise ValueError("at least one check is needed")
    counts: list[tuple[str, str, Column, int]] = []
    shared: dict[str, Check] = {}
    frames: list[DataFrame] = []

    for check in checks:
        joined = ", ".join(check.columns)
        if check.kind == "non_empty":
            none = F.when(F.count(F.lit(1)) == 0, 1).otherwise(0).cast("bigint")
            counts.append(("non_empty", "", none, 1))
        elif check.kind == "no_nulls":
            counts.append(("no_nulls", joined, F.count_if(any_null(check.columns)), 0))
        elif check.kind == "non_negative":
            counts += [("non_negative", c, F.count_if(negative(c)), 0) for c in check.columns]
        elif check.kind == "references" and joined not in shared:
            shared[joined] = check
        else:
            if check.kind == "references":
                found = orphans(df, check.dim, [(check.columns[0], check.dim_key)])
                counter = F.coalesce(F.sum("orphan_rows"), F.lit(0).cast("bigint"))
            else:
                found = duplicates(df, check.columns)
                counter = F.count(F.lit(1))
            one = found.agg(counter.alias("v"))
            frames.append(one.select(F.inline(F.array(_result(table, check.kind, joined, F.col("v"))))))
    if len(shared) == 1 and not counts:
        ((name, check),) = shared.items()
        one = orphans(df, check.dim, [(name, check.dim_key)]).agg(F.sum("orphan_rows").alias("n"))
        violations = F.coalesce("n", F.lit(0).cast("bigint"))
        frames = [one.select(F.inline(F.array(_result(table, check.kind, name, violations)))), *frames]
    elif shared:
        frames = [_one_scan(table, df, counts, list(shared.values())), *frames]
    elif counts:
        counted = df.agg(*[c.alias(f"v{i}") for i, (_, _, c, _) in enumerate(counts)])
        results = [_result(table, kind, unit, F.col(f"v{i}")) for i, (kind, unit, _, _) in enumerate(counts)]
        frames = [counted.select(F.inline(F.array(*results))), *frames]
    return combine(frames)


def _one_scan(
    table: str, df: DataFrame, counts: Sequence[tuple[str, str, Column, int]], references: Sequence[Check]
) -> DataFrame:
    """Counts over the whole table, each with what it is of an empty one, and rows without a partner by key."""
    keys = [f"_key{i}" for i in range(len(references))]
    keyed = df.withColumns({k: F.col(check.columns[0]) for k, check in zip(keys, references)})
    # Which set a group is of: one bit for each key it is not by, the first key's the highest.
    whole = 2 ** len(keys) - 1
    by_key = [whole - 2 ** (len(keys) - 1 - i) for i in range(len(keys))]
    sets = [[F.col(k)] for k in keys] + ([[]] if counts else [])
    left = keyed.groupingSets(sets, *[F.col(k) for k in keys]).agg(
        F.grouping_id().alias("_set"),
        F.count(F.lit(1)).alias("_rows"),
        *[c.alias(f"_v{i}") for i, (_, _, c, _) in enumerate(counts)],
    )
    for key, number, check in zip(keys, by_key, references):
        side = check.dim.select(F.col(check.dim_key).alias(f"_dim{key}"))
        known = (F.col("_set") == number) & (F.col(key) == F.col(f"_dim{key}"))
        left = left.join(side, known, "left_anti")
    of_whole = [
        F.coalesce(F.max(F.when(F.col("_set") == whole, F.col(f"_v{i}"))), F.lit(empty).cast("bigint"))
        for i, (_, _, _, empty) in enumerate(counts)
    ]
    orphaned = [
        F.coalesce(F.sum(F.when(F.col("_set") == number, F.col("_rows"))), F.lit(0).cast("bigint"))
        for number in by_key
    ]
    found = left.agg(*[c.alias(f"v{i}") for i, c in enumerate([*of_whole, *orphaned])])
    units = [(kind, unit) for kind, unit, _, _ in counts] + [(c.kind, c.columns[0]) for c in references]
    return found.select(
        F.inline(F.array(*[_result(table, kind, unit, F.col(f"v{i}")) for i, (kind, unit) in enumerate(units)]))
    )


def combine(reports: Sequence[DataFrame]) -> DataFrame:
    """Reports of several tables as one, still a single Spark action."""
    return reduce(DataFrame.unionByName, reports)


def settled(report: DataFrame) -> DataFrame:
    """The report, worked out once and held as rows of the driver: one for each check, none of a table."""
    return report.sparkSession.createDataFrame(report.collect(), report.schema)


def gate(report: DataFrame) -> None:
    """Raise with every failed check. Brings failed report rows to the driver, never table rows."""
    failed = report.where(~F.col("passed")).orderBy("table_name", "check_name", "column_name")
    messages = [
        f"{r.table_name} {r.check_name}({r.column_name}): {r.violations} violations"
        for r in failed.collect()
    ]
    if messages:
        raise QualityGateError(messages)
