"""Row predicates given as data: a rule is a SQL condition or a Column under a name."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

Rules = Mapping[str, "str | Column"]


def rule_columns(rules: Rules) -> dict[str, Column]:
    if not rules:
        raise ValueError("at least one rule is needed")
    return {n: F.expr(r) if isinstance(r, str) else r for n, r in rules.items()}


def all_hold(rules: Rules) -> Column:
    """Every rule is TRUE. A NULL rule does not hold, so ``where`` drops that row."""
    return reduce(and_, rule_columns(rules).values())


def any_null(columns: Iterable[str]) -> Column:
    tests = [F.col(c).isNull() for c in columns]
    if not tests:
        raise ValueError("at least one column is needed")
    return reduce(or_, tests)


def negative(column: str) -> Column:
    """Below zero. NULL and NaN are not."""
    return F.col(column) < 0
