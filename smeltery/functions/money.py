"""Exact sums over amounts stored as doubles.

Adding doubles depends on the order of the rows, so a retried task or another partitioning can move
a sum across a half cent. Every row is therefore taken apart into whole numbers, whose sums are exact
and independent of order: a count of 10^-UNIT_DECIMALS, and for a value between two counts the rest in
2^-REST_BITS of a unit. Counts are added in limbs of LIMB_BITS, so that no number of rows overflows a bigint.

Values too large for a bigint of units are split by exponent into the same limbs and two more. The uppermost
is a whole double that counts 2^75 units: it cannot overflow, and adds up exactly to totals of 3e34.

The parts are SQL text: one call to the JVM for an expression, where a tree of columns takes one for each node.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNIT_DECIMALS = 4
# Above 2^50 units a double no longer separates neighbouring units safely.
_MAX_UNITS = 2**50
REST_BITS = 24
LIMB_BITS = 25
_SCALE = f"{10**UNIT_DECIMALS}D"
_LIMIT = f"{_MAX_UNITS / 10**UNIT_DECIMALS!r}D"
# Beyond this the count of units itself is no finite double.
_HUGE = "1e300D"
_THIRD, _FOURTH = f"{float(2 ** (2 * LIMB_BITS))!r}D", f"{float(2 ** (3 * LIMB_BITS))!r}D"


def units(amount: Column, decimals: int = UNIT_DECIMALS) -> Column:
    """``amount`` as the nearest count of 10^-decimals. Only to be used where ``is_exact`` holds:
    NaN, infinities and huge values give some number, not an error."""
    return F.floor(amount.cast("double") * F.lit(float(10**decimals)) + F.lit(0.5))


def is_exact(amount: Column, decimals: int = UNIT_DECIMALS) -> Column:
    """TRUE when the double is precisely the one nearest to its unit count; NULL for NULL."""
    scale = float(10**decimals)
    value = amount.cast("double")
    back = units(amount, decimals).cast("double") / F.lit(scale)
    # NaN counts as greater than the bound.
    return (F.abs(value) <= _MAX_UNITS / scale) & (back == value)


def row_parts(c: str, i: int) -> list[str]:
    """The whole numbers of one double, as SQL over the column ``c``; NULL where a part has nothing to add.

    ``_count`` holds the two lower limbs, ``_rest`` what is over, and ``_large`` the values beyond 2^50 units.
    """
    counted = f"floor({c} * {_SCALE} + 0.5D)"
    return [
        f"CASE WHEN abs({c}) <= {_LIMIT} THEN {counted} "
        f"WHEN abs({c}) < {_HUGE} THEN CAST(rint({c} * {_SCALE}) % {_THIRD} AS BIGINT) END AS _count{i}",
        f"CASE WHEN abs({c}) <= {_LIMIT} AND {counted} / {_SCALE} <> {c} "
        f"THEN floor(({c} * {_SCALE} - {counted}) * {2**REST_BITS}D + 0.5D) END AS _rest{i}",
        f"CASE WHEN NOT abs({c}) <= {_LIMIT} THEN {c} END AS _large{i}",
    ]


def row_sums(i: int) -> list[str]:
    """Sums of the limbs, to be added up by ``merged_sums`` where groups are put together."""
    whole = f"rint(_large{i} * {_SCALE})"
    return [
        f"sum(shiftright(_count{i}, {LIMB_BITS})) AS _high{i}",
        f"sum(_count{i} & {(1 << LIMB_BITS) - 1}) AS _low{i}",
        f"sum(_rest{i}) AS _rest{i}",
        f"sum(CASE WHEN abs(_large{i}) < {_HUGE} THEN CAST(({whole} % {_FOURTH}) / {_THIRD} AS BIGINT) END) AS _third{i}",
        f"sum(CASE WHEN abs(_large{i}) < {_HUGE} THEN ({whole} - {whole} % {_FOURTH}) / {_FOURTH} "
        f"ELSE _large{i} / {_FOURTH} * {_SCALE} END) AS _fourth{i}",
    ]


def merged_sums(i: int) -> list[str]:
    return [f"sum(_{part}{i}) AS _{part}{i}" for part in ("high", "low", "rest", "third", "fourth")]


def totals(i: int) -> list[str]:
    """The sum of one column, as SQL over its limbs: whole units, what is over in 2^-REST_BITS of one, and as a double.

    ``_units`` is NULL where only the double counts: beyond some 2e14, where a double no longer tells cents apart.
    """
    high, low, rest, third = (f"coalesce(_{part}{i}, 0L)" for part in ("high", "low", "rest", "third"))
    return [
        f"CASE WHEN _fourth{i} IS NULL AND abs({high}) < {1 << 36}L AND abs({third}) < {1 << 11}L THEN "
        f"{third} * {1 << 2 * LIMB_BITS}L + {high} * {1 << LIMB_BITS}L + {low} + shiftright({rest}, {REST_BITS}) END "
        f"AS _units{i}",
        f"{rest} & {(1 << REST_BITS) - 1}L AS _over{i}",
        f"coalesce(_fourth{i}, 0D) * ({_FOURTH} / {_SCALE}) + ({third} * {_THIRD} + {high} * {1 << LIMB_BITS}D + {low}"
        f" + {rest} / {2**REST_BITS}D) / {_SCALE} AS _plain{i}",
    ]


def rounded(i: int, divisor: str, decimals: int) -> str:
    """The total over a divisor, rounded half away from zero, as SQL over what ``totals`` gives."""
    by = f"({10 ** (UNIT_DECIMALS - decimals)}L * {divisor})"

    def quotient(size: str, above: str) -> str:
        up = f"CASE WHEN 2 * ({size} % {by}) + shiftright({above}, {REST_BITS - 1}) >= {by} THEN 1L ELSE 0L END"
        return f"({size} div {by} + {up})"

    negative = quotient(f"(-_units{i} - sign(_over{i})::bigint)", f"(-_over{i} & {(1 << REST_BITS) - 1}L)")
    exact = f"CASE WHEN _units{i} < 0 THEN -{negative} ELSE {quotient(f'_units{i}', f'_over{i}')} END / {10**decimals}D"
    return f"CASE WHEN _units{i} IS NULL THEN round(_plain{i} / {divisor}, {decimals}) ELSE {exact} END"


def half_up_quotient(numerator: Column, divisor: Column) -> Column:
    """Integer division rounded half away from zero; ``divisor`` must be positive."""
    size = F.abs(numerator)
    rest = size % divisor
    up = F.when(rest >= divisor - rest, 1).otherwise(0)
    return F.signum(numerator).cast("bigint") * (F.call_function("div", size, divisor) + up)
