"""Bring files of differing physical types to one declared schema."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# (name, type) or (source name, target name, type); type None keeps the column as it is.
ColumnSpec = tuple

_INTEGRAL = {"tinyint": 1, "smallint": 2, "int": 4, "bigint": 8}


def _spec(column: ColumnSpec) -> tuple[str, str, str | None]:
    if len(column) == 2:
        return column[0], column[0], column[1]
    return column


def _types(df: DataFrame, names: Iterable[str]) -> dict[str, str]:
    """Types of the named columns, resolved as Spark would; a missing one fails at analysis."""
    known = dict(df.dtypes)
    if all(n in known for n in names):
        return known
    names = list(names)
    return dict(zip(names, (t for _, t in df.select(*names).dtypes)))


def _widens(source: str, target: str) -> bool:
    if source in _INTEGRAL and target in _INTEGRAL:
        return _INTEGRAL[source] <= _INTEGRAL[target]
    if source in _INTEGRAL or source == "float":
        return target == "double"
    return {source, target} == {"timestamp", "timestamp_ntz"} or target == "string"


def keeps_order(source: str, target: str | None) -> bool:
    """The cast keeps a value as it is or makes it NULL, so raw and cast values compare alike."""
    if target is None or source == target:
        return True
    if source in _INTEGRAL and target in _INTEGRAL:
        return True
    # A bigint may be rounded on its way to double.
    return source in _INTEGRAL and source != "bigint" and target == "double"


def convert(column: Column, source: str, target: str | None) -> Column:
    """Cast without failing the job: a value the target cannot hold becomes NULL.

    Casts that cannot fail stay plain, since the optimizer moves comparisons through those.
    """
    if target is None or source == target:
        return column
    if _widens(source, target):
        return column.cast(target)
    if target in _INTEGRAL and (source in _INTEGRAL or source in ("float", "double")):
        # A range test, since a failing try_cast costs an exception per value.
        return F.when(_fits(column, source, target), column.cast(target))
    if source == "string" and target in _INTEGRAL:
        # '7.9' counts as 7 and '.5' as 0: the fraction of a well-formed number is cut, not rejected.
        whole = F.regexp_extract(F.trim(column), r"^([+-]?\d+)\.\d*$", 1)
        fraction = F.when(F.trim(column).rlike(r"^[+-]?\.\d+$"), F.lit(0).cast(target))
        return F.coalesce(column.try_cast(target), F.nullif(whole, F.lit("")).try_cast(target), fraction)
    return column.try_cast(target)


def _fits(column: Column, source: str, target: str) -> Column:
    """The value, cut to a whole number, lies in the range of ``target``. FALSE for NaN."""
    high = 2 ** (8 * _INTEGRAL[target] - 1)
    if source in _INTEGRAL:
        return column.between(-high, high - 1)
    value = column.cast("double")
    # -2^63 - 1 is no double of its own.
    above = value >= float(-high) if target == "bigint" else value > float(-high - 1)
    return above & (value < float(high))


def conform_columns(df: DataFrame, columns: Sequence[ColumnSpec]) -> list[Column]:
    """The listed columns of ``df``, renamed and cast."""
    specs = [_spec(c) for c in columns]
    if not specs:
        raise ValueError("the column list is empty")
    types = _types(df, [s for s, _, _ in specs])
    return [convert(F.col(s), types[s], t).alias(n) for s, n, t in specs]


def conform(df: DataFrame, columns: Sequence[ColumnSpec]) -> DataFrame:
    """Select, rename and cast the listed columns; a missing one fails at analysis."""
    return df.select(conform_columns(df, columns))


def lost_flags(df: DataFrame, columns: Sequence[ColumnSpec]) -> dict[str, Column]:
    """By target column: a non-null value of ``df`` that the declared type cannot hold."""
    specs = [_spec(c) for c in columns]
    types = _types(df, [s for s, _, _ in specs])
    return {n: F.col(s).isNotNull() & convert(F.col(s), types[s], t).isNull() for s, n, t in specs}


def union_conformed(frames: Iterable[DataFrame]) -> DataFrame:
    """Bag union by name; frames must have the same columns."""
    frames = list(frames)
    if not frames:
        raise ValueError("nothing to union: the list of periods is empty")
    return reduce(DataFrame.unionByName, frames)


def cast_losses(df: DataFrame, columns: Sequence[ColumnSpec]) -> DataFrame:
    """Per column, how many non-null values the declared type cannot hold. One pass."""
    flags = lost_flags(df, columns)
    counted = df.agg(*[F.count_if(flag).alias(n) for n, flag in flags.items()])
    rows = [F.struct(F.lit(n).alias("column_name"), F.col(n).alias("lost_values")) for n in flags]
    return counted.select(F.inline(F.array(*rows)))


def stamp_ingested(df: DataFrame, column: str = "_ingested_at") -> DataFrame:
    """Add the load time, one value for the whole query."""
    return df.withColumn(column, F.current_timestamp())


def early_columns(df: DataFrame, columns: Sequence[ColumnSpec]) -> list[Column]:
    """The target columns, still raw where comparing raw values is safe."""
    specs = [_spec(c) for c in columns]
    types = _types(df, [s for s, _, _ in specs])
    picked = []
    for source, name, target in specs:
        raw, dtype = F.col(source), types[source]
        picked.append((raw if keeps_order(dtype, target) else convert(raw, dtype, target)).alias(name))
    return picked


def late_columns(df: DataFrame, columns: Sequence[ColumnSpec]) -> list[Column]:
    """The target columns cast from the frame ``early_columns`` made."""
    types = dict(df.dtypes)
    return [
        convert(F.col(name), types[name], target).alias(name) for _, name, target in map(_spec, columns)
    ]

