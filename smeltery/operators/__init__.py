from .conform import cast_losses, conform, stamp_ingested, union_conformed
from .quality import (
    QualityGateError,
    audit,
    combine,
    duplicates,
    gate,
    no_nulls,
    non_empty,
    non_negative,
    orphans,
    references,
    settled,
    unique,
)
from .refine import (
    Outcomes,
    add_duration,
    apply_rules,
    conform_and_filter,
    dedup,
    losses_and_rejects,
    rule_rejects,
)
from .rollup import Dim, Measure, mean, rollup, row_count, total
from .star import attribute_dim, date_dim, fact, static_dim

__all__ = [
    "Dim",
    "Measure",
    "Outcomes",
    "QualityGateError",
    "add_duration",
    "apply_rules",
    "attribute_dim",
    "audit",
    "cast_losses",
    "combine",
    "conform",
    "conform_and_filter",
    "date_dim",
    "dedup",
    "duplicates",
    "fact",
    "gate",
    "losses_and_rejects",
    "mean",
    "no_nulls",
    "non_empty",
    "non_negative",
    "orphans",
    "references",
    "rollup",
    "row_count",
    "rule_rejects",
    "settled",
    "stamp_ingested",
    "static_dim",
    "total",
    "union_conformed",
    "unique",
]
