"""Row rules, derived columns and de-duplication."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import all_hold, minutes_between, rule_columns
from ..functions.predicates import Rules
from .conform import ColumnSpec, conform_columns, early_columns, late_columns, lost_flags

# A null test, or a comparison of a column with a number or another column.
_PLAIN_RULE = re.compile(r"\w+\s+IS\s+NOT\s+NULL|\w+\s*(<|<=|>|>=|=)\s*(\w+|-?\d+(\.\d+)?)", re.I)


def apply_rules(df: DataFrame, rules: Rules) -> DataFrame:
    """Keep the rows for which every rule is TRUE."""
    return df.where(all_hold(rules))


def conform_and_filter(df: DataFrame, columns: Sequence[ColumnSpec], rules: Rules) -> DataFrame:
    """``apply_rules(conform(df, columns), rules)``, with the range tests pushed into the scan.

    A narrowing cast keeps a comparison out of the parquet filter. So the plain comparisons among
    the rules run on the raw columns first; all rules run after the cast, which also rejects the
    values the cast could not hold.
    """
    early = df.select(early_columns(df, columns))
    plain = {n: r for n, r in rules.items() if isinstance(r, str) and _PLAIN_RULE.fullmatch(r.strip())}
    if plain:
        early = early.where(all_hold(plain))
    return early.select(late_columns(early, columns)).where(all_hold(rules))


def rule_rejects(df: DataFrame, rules: Rules) -> DataFrame:
    """Rows each rule rejects on its own, in one pass over the data."""
    tests = rule_columns(rules)
    counted = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(~F.coalesce(t, F.lit(False))).alias(f"r{i}") for i, t in enumerate(tests.values())],
    )
    rows = [
        F.struct(
            F.lit(name).alias("rule_name"),
            F.col(f"r{i}").alias("rejected_rows"),
            F.col("total_rows"),
        )
        for i, name in enumerate(tests)
    ]
    return counted.select(F.inline(F.array(*rows)))


def _outcomes(df: DataFrame, columns: Sequence[ColumnSpec], rules: Rules) -> tuple[list, list, list]:
    """Columns to select, counts over them, and check and unit of each count."""
    lost = lost_flags(df, columns)
    tests = rule_columns(rules)
    flags = {f"_lost{i}": flag for i, flag in enumerate(lost.values())}
    counts = [F.count_if(F.col(name)).alias(name) for name in flags]
    counts += [F.count_if(~F.coalesce(t, F.lit(False))).alias(f"_reject{i}") for i, t in enumerate(tests.values())]
    units = [("cast_loss", name) for name in lost] + [("rule_reject", name) for name in tests]
    return [*conform_columns(df, columns), *[c.alias(n) for n, c in flags.items()]], counts, units


_OUTCOME = "check_name string, column_name string, violations bigint"


def losses_and_rejects(df: DataFrame, columns: Sequence[ColumnSpec], rules: Rules) -> DataFrame:
    """Values lost to casts by column and rows rejected by rule, each rule on its own. One pass for all."""
    selected, counts, units = _outcomes(df, columns, rules)
    counted = df.select(selected).agg(*counts)
    rows = [
        F.struct(F.lit(check).alias("check_name"), F.lit(unit).alias("column_name"), F.col(name).alias("violations"))
        for (check, unit), name in zip(units, counted.columns)
    ]
    return counted.select(F.inline(F.array(*rows)))


class Outcomes:
    """``losses_and_rejects`` counted while ``frame`` is written, without a scan of its own.

    Put the write directly above ``frame``: then each row is counted by the task that writes it, and a task that
    fails and runs again counts once. A shuffle between the two could count rows of a stage that is run again twice.
    """

    def __init__(self, df: DataFrame, columns: Sequence[ColumnSpec], rules: Rules):
        selected, counts, self._units = _outcomes(df, columns, rules)
        self._observed = Observation()
        whole = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_whole")
        self.frame = df.select(whole, *selected).observe(self._observed, *counts).select("_whole.*")

    def report(self) -> DataFrame:
        """The counts. Call after the write; before, it would wait for one."""
        found = self._observed.get
        rows = [(check, unit, value) for (check, unit), value in zip(self._units, found.values())]
        return self.frame.sparkSession.createDataFrame(rows, _OUTCOME)


def add_duration(
    df: DataFrame,
    start: str,
    end: str,
    date_column: str = "pickup_date",
    minutes_column: str = "trip_duration_minutes",
) -> DataFrame:
    """Add the calendar date of ``start`` and the fractional minutes from ``start`` to ``end``."""
    types = {f.name: f.dataType for f in df.select(start, end).schema}
    return df.withColumns(
        {
            date_column: F.to_date(start),
            minutes_column: minutes_between(F.col(start), F.col(end), types[start], types[end]),
        }
    )


def dedup(df: DataFrame, keys: Sequence[str], prefer: Sequence = ()) -> DataFrame:
    """One row per key; NULL keys equal each other.

    The survivor is the first row in the order of ``prefer``, then of all other columns that have an
    order, so it is the same row on every run. Maps and variants have none: among rows that differ
    in those alone, any may survive. Spark turns the rank filter into a group limit that runs before
    the shuffle as well: each map task sends at most one row per key, however often a key repeats.
    """
    if not keys:
        raise ValueError("at least one key column is needed")
    named = [p for p in prefer if isinstance(p, str)]
    rest = [f.name for f in df.schema if f.name not in keys and f.name not in named and _has_order(f.dataType)]
    order = [*prefer, *[F.col(f"`{name}`") for name in rest]]
    if not order:
        return df.dropDuplicates(list(keys))
    rank = "rank"
    while rank in {c.lower() for c in df.columns}:
        rank += "_"
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(rank, number).where(F.col(rank) == 1).drop(rank)


def _has_order(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _has_order(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_has_order(f.dataType) for f in kind)
    return not isinstance(kind, (T.MapType, T.VariantType))
