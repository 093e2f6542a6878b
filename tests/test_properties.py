"""Random small inputs against plain Python."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from smeltery.operators import (
    apply_rules,
    audit,
    dedup,
    duplicates,
    no_nulls,
    non_negative,
    orphans,
    rule_rejects,
)

small = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
value = st.one_of(st.none(), st.integers(-2, 2))
rows = st.lists(st.tuples(value, value, value), max_size=25)


def first_null(row):
    return tuple((v is not None, v or 0) for v in row)


@small
@given(rows)
def test_dedup(spark, data):
    df = spark.createDataFrame(data, "a int, b int, c int")
    best = {}
    for row in sorted(data, key=lambda r: first_null((r[2], r[0], r[1]))):
        best.setdefault(row[:2], row)
    assert sorted(map(str, map(tuple, dedup(df, ["a", "b"]).collect()))) == sorted(map(str, best.values()))


@small
@given(rows)
def test_rules_in_three_valued_logic(spark, data):
    df = spark.createDataFrame(data, "a int, b int, c int")
    rules = {"less": "a < b", "positive": "c > 0"}
    holds = {
        "less": lambda r: None not in r[:2] and r[0] < r[1],
        "positive": lambda r: r[2] is not None and r[2] > 0,
    }
    kept = [r for r in data if all(h(r) for h in holds.values())]
    assert sorted(map(tuple, apply_rules(df, rules).collect())) == sorted(kept)
    rejected = {r.rule_name: (r.rejected_rows, r.total_rows) for r in rule_rejects(df, rules).collect()}
    assert rejected == {n: (sum(not h(r) for r in data), len(data)) for n, h in holds.items()}


@small
@given(rows, st.lists(value, max_size=6))
def test_checks(spark, data, known):
    df = spark.createDataFrame(data, "a int, b int, c int")
    dim = spark.createDataFrame([(k,) for k in known], "key int")
    report = audit("t", df, [no_nulls("a", "b"), non_negative("c")])
    assert {r.check_name: r.violations for r in report.collect()} == {
        "no_nulls": sum(None in r[:2] for r in data),
        "non_negative": sum(r[2] is not None and r[2] < 0 for r in data),
    }
    lost = [r[0] for r in data if r[0] is None or r[0] not in known]
    found = {r.a: r.orphan_rows for r in orphans(df, dim, [("a", "key")]).collect()}
    assert found == {k: lost.count(k) for k in set(lost)}
    keys = [r[:2] for r in data if None not in r[:2]]
    repeated = {(r.a, r.b): r.key_rows for r in duplicates(df, ["a", "b"]).collect()}
    assert repeated == {k: keys.count(k) for k in set(keys) if keys.count(k) > 1}


def test_dedup_keeps_columns_whatever_they_are_called(spark):
    df = spark.sql("SELECT 1 AS k, 5 AS rank, 6 AS rank_, map('a', 1) AS m UNION ALL SELECT 1, 4, 6, map('b', 2)")
    (row,) = dedup(df, ["k"]).collect()
    assert (row["rank"], row["rank_"], row["m"]) == (4, 6, {"b": 2})
