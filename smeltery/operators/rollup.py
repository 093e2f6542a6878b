"""Grouped counts, sums and averages over a fact table and its dimensions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.money import UNIT_DECIMALS, merged_sums, rounded, row_parts, row_sums, totals


class Measure(NamedTuple):
    name: str
    kind: str
    column: str | None = None
    decimals: int = 2


class Dim(NamedTuple):
    """Inner join ``frame`` on ``fact_key = dim_key`` and group by ``attributes``.

    An attribute is a column, or a pair of a column and the name it gets in the result, for two
    dimensions that share a column name.
    """

    frame: DataFrame
    fact_key: str
    dim_key: str
    attributes: Sequence[str | tuple[str, str]]


def row_count(name: str) -> Measure:
    return Measure(name, "rows")


def total(name: str, column: str, decimals: int = 2) -> Measure:
    return Measure(name, "total", column, decimals)


def mean(name: str, column: str, decimals: int = 2) -> Measure:
    return Measure(name, "mean", column, decimals)


_WHOLE = {"tinyint", "smallint", "int", "bigint"}


def _is_double(dtype: str) -> bool:
    return dtype not in _WHOLE and not dtype.startswith("decimal")


def _quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def _taken_apart(fact: DataFrame, keys: Mapping[str, str], columns: Mapping[str, str]) -> DataFrame:
    """Keys, values and the whole numbers of each double, computed once per row, before the sums."""
    parts = []
    for i, (name, dtype) in enumerate(columns.items()):
        value = _quoted(name)
        if _is_double(dtype):
            value = value if dtype == "double" else f"CAST({value} AS DOUBLE)"
            parts += row_parts(value, i)
        parts.append(f"{value} AS _value{i}")
    return fact.select(*[F.col(key).alias(name) for key, name in keys.items()], *map(F.expr, parts))


def _first_sums(columns: Mapping[str, str]) -> list[Column]:
    sums = ["count(1) AS _rows"]
    for i, dtype in enumerate(columns.values()):
        sums.append(f"count(_value{i}) AS _known{i}")
        if _is_double(dtype):
            sums += row_sums(i)
        else:
            value = f"CAST(_value{i} AS DECIMAL(20,0))" if dtype in _WHOLE else f"_value{i}"
            sums.append(f"sum({value}) AS _sum{i}")
    return [F.expr(s) for s in sums]


def _merged(columns: Mapping[str, str]) -> list[Column]:
    # No groups at all make one row of nothing, which counts zero rows.
    sums = ["coalesce(sum(_rows), 0L) AS _rows"]
    for i, dtype in enumerate(columns.values()):
        sums.append(f"coalesce(sum(_known{i}), 0L) AS _known{i}")
        sums += merged_sums(i) if _is_double(dtype) else [f"sum(_sum{i}) AS _sum{i}"]
    return [F.expr(s) for s in sums]


def _with_totals(grouped: DataFrame, keys: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """The sums of doubles put together from their limbs; others stay as they are."""
    kept = [_quoted(k) for k in keys] + ["_rows"] + [f"_known{i}" for i in range(len(columns))]
    kept += [f"_sum{i}" for i, dtype in enumerate(columns.values()) if not _is_double(dtype)]
    doubles = [totals(i) for i, dtype in enumerate(columns.values()) if _is_double(dtype)]
    return grouped.selectExpr(*kept, *[text for column in doubles for text in column])


def _finish(measure: Measure, columns: Mapping[str, str]) -> str:
    name = _quoted(measure.name)
    if measure.kind == "rows":
        return f"_rows AS {name}"
    if not 0 <= measure.decimals <= UNIT_DECIMALS:
        raise ValueError(f"decimals must lie between 0 and {UNIT_DECIMALS}")
    i = list(columns).index(measure.column)
    dtype = columns[measure.column]
    divisor = f"greatest(_known{i}, 1L)" if measure.kind == "mean" else "1L"
    if _is_double(dtype):
        result = rounded(i, divisor, measure.decimals)
    elif measure.kind == "mean":
        result = f"round(_sum{i} / {divisor}, {measure.decimals})"
    elif dtype in _WHOLE:
        result = f"CAST(_sum{i} AS BIGINT)"
    else:
        result = f"round(_sum{i}, {measure.decimals})"
    return f"CASE WHEN _known{i} > 0 THEN {result} END AS {name}"


def rollup(
    fact: DataFrame,
    measures: Sequence[Measure],
    keys: Sequence[str] = (),
    dims: Sequence[Dim] = (),
    order_by: Sequence[Column | str] = (),
) -> DataFrame:
    """Group ``fact`` by its own ``keys`` and the attributes of joined ``dims``.

    Sums and averages round half away from zero, and do not depend on the order of rows. Doubles are
    added as whole numbers, row by row, whatever else a group holds; values beyond 10^11 as decimals.
    Only NaN, infinities and values beyond 10^31 are added as doubles. Decimals and whole numbers are added
    as they are: totals of decimals stay decimals, totals of whole numbers are bigint.

    With dimensions the fact is grouped by its foreign keys *before* the join. Counts and sums add
    up again afterwards, so the result is the same, but the join sees one row per key instead of
    the fact: a hot key collapses in the map tasks, and no dimension has to fit a broadcast.
    """
    types = dict(fact.dtypes)
    columns = {m.column: types[m.column] for m in measures if m.column}
    key_names = list(dict.fromkeys([*keys, *[d.fact_key for d in dims]]))
    inner = {key: f"_key{i}" for i, key in enumerate(key_names)}
    # A NULL foreign key cannot match: drop it before grouping rather than in the join.
    for d in dims:
        fact = fact.where(F.col(d.fact_key).isNotNull())
    grouped = _taken_apart(fact, inner, columns).groupBy(*inner.values()).agg(*_first_sums(columns))
    for n, d in enumerate(dims):
        named = [F.col(a).alias(a) if isinstance(a, str) else F.col(a[0]).alias(a[1]) for a in d.attributes]
        side = d.frame.select(F.col(d.dim_key).alias(f"_dim{n}"), *named)
        grouped = grouped.join(side, F.col(inner[d.fact_key]) == F.col(f"_dim{n}"))
    out_keys = [inner[k] for k in keys]
    if dims:
        attributes = [a if isinstance(a, str) else a[1] for d in dims for a in d.attributes]
        grouped = grouped.groupBy(*out_keys, *attributes).agg(*_merged(columns))
        out_keys += attributes
    shown = [F.col(_quoted(k)).alias(name) for k, name in zip(out_keys, [*keys, *out_keys[len(keys) :]])]
    finished = _with_totals(grouped, out_keys, columns)
    result = finished.select(*shown, *[F.expr(_finish(m, columns)) for m in measures])
    return result.orderBy(*order_by) if order_by else result
