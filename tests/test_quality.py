import pytest
from pyspark.sql import functions as F

from smeltery.operators import (
    QualityGateError,
    audit,
    combine,
    dedup,
    duplicates,
    gate,
    no_nulls,
    non_empty,
    non_negative,
    orphans,
    references,
    unique,
)
from smeltery.session import overriding
from tests_support import plan_of


@pytest.fixture
def fact(spark):
    return spark.createDataFrame(
        [(1, 1.0, "a"), (2, -1.0, "a"), (2, float("nan"), None), (None, None, None), (9, -0.0, "b")],
        "k int, amount double, tag string",
    )


@pytest.fixture
def dim(spark):
    return spark.createDataFrame([(1,), (2,), (2,), (None,)], "key bigint")


def violations(report):
    return {(r.check_name, r.column_name): (r.violations, r.passed) for r in report.collect()}


def test_every_check(fact, dim):
    report = audit(
        "t",
        fact,
        [
            non_empty(),
            no_nulls("k", "tag"),
            no_nulls("k"),
            non_negative("amount", "k"),
            references("k", dim, "key"),
            unique("tag"),
            unique("k", "tag"),
        ],
    )
    assert violations(report) == {
        ("non_empty", ""): (0, True),
        ("no_nulls", "k, tag"): (2, False),
        ("no_nulls", "k"): (1, False),
        ("non_negative", "amount"): (1, False),  # neither NaN nor -0.0 is below zero
        ("non_negative", "k"): (0, True),
        ("references", "k"): (2, False),  # 9 and the NULL key
        ("unique", "tag"): (1, False),  # two 'a'; the NULLs do not count
        ("unique", "k, tag"): (0, True),
    }


def test_empty_table(fact, dim):
    report = audit("t", fact.where("k > 100"), [non_empty(), no_nulls("k"), references("k", dim, "key")])
    assert violations(report) == {
        ("non_empty", ""): (1, False),
        ("no_nulls", "k"): (0, True),
        ("references", "k"): (0, True),
    }


def test_row_checks_share_one_scan(spark, tmp_path, fact, dim):
    fact.write.parquet(str(tmp_path / "f"))
    stored = spark.read.parquet(str(tmp_path / "f"))
    checks = [non_empty(), no_nulls("k", "tag"), non_negative("amount"), no_nulls("tag")]
    assert plan_of(audit("t", stored, checks)).split("\n\n")[0].count("Scan parquet") == 1


def test_references_share_the_scan_of_row_checks(spark, tmp_path, dim):
    rows = "IF(id % 5 = 0, NULL, CAST(id % 7 AS INT)) AS k, CAST(id % 3 AS STRING) AS tag, CAST(id - 4 AS DOUBLE) AS amount"
    spark.sql(f"SELECT {rows} FROM range(1000)").write.parquet(str(tmp_path / "f"))
    stored = spark.read.parquet(str(tmp_path / "f"))
    tags = spark.createDataFrame([("0",), ("2",), ("2",)], "tag string")
    nothing = tags.limit(0)
    checks = [
        non_empty(), no_nulls("k"), non_negative("amount"), references("k", dim, "key"), references("tag", tags, "tag")
    ]
    for threshold in ("10MB", "-1"):
        with overriding(spark, {"spark.sql.autoBroadcastJoinThreshold": threshold}):
            report = audit("t", stored, checks)
            assert plan_of(report).split("\n\n")[0].count("Scan parquet") == 1
            assert violations(report) == {
                ("non_empty", ""): (0, True),
                ("no_nulls", "k"): (200, False),
                ("non_negative", "amount"): (4, False),
                ("references", "k"): (1000 - stored.where("k IN (1, 2)").count(), False),
                ("references", "tag"): (333, False),
            }
            both = audit("t", stored, [references("tag", nothing, "tag"), references("k", dim, "key")])
            assert violations(both)["references", "tag"] == (1000, False)
            empty = audit("t", stored.where("amount > 5000"), checks)
            assert {v for v, _ in violations(empty).values()} == {0, 1}
            assert violations(empty)["non_empty", ""] == (1, False)
    # The same column against two dimensions: each has its own answer.
    twice = audit("t", stored, [references("tag", tags, "tag"), references("tag", nothing, "tag"), non_empty()])
    assert sorted(r.violations for r in twice.collect()) == [0, 333, 1000]


def test_orphan_keys_with_counts(spark, dim):
    df = spark.sql("SELECT CAST(IF(id % 3 = 0, NULL, id % 4) AS INT) AS k FROM range(120)")
    got = {r.k: r.orphan_rows for r in orphans(df, dim, [("k", "key")]).collect()}
    assert got == {None: 40, 0: 20, 3: 20}


def test_large_dimensions_see_grouped_keys(spark):
    """Without a broadcast the fact is counted per key before the join, and not shuffled again."""
    fact = spark.range(7 * 143).select((F.col("id") % 7).alias("k"))
    known = spark.range(5).select(F.col("id").alias("key"))
    with overriding(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        result = orphans(fact, known, [("k", "key")])
        tree = plan_of(result).split("\n\n")[0]
        assert {tuple(r) for r in result.collect()} == {(5, 143), (6, 143)}
    assert tree.index("SortMergeJoin") < tree.index("HashAggregate")
    assert tree.count("Exchange") == 2


def test_orphans_on_two_columns(spark):
    fact = spark.createDataFrame([(1, "a"), (1, "b"), (None, "a")], "x int, y string")
    dim = spark.createDataFrame([(1, "a")], "p int, q string")
    got = orphans(fact, dim, [("x", "p"), ("y", "q")])
    assert {tuple(r) for r in got.collect()} == {(1, "b", 1), (None, "a", 1)}


def test_duplicate_keys(fact):
    assert [tuple(r) for r in duplicates(fact, ["k"]).collect()] == [(2, 2)]


def test_gate_names_every_failure_and_passes_otherwise(fact, dim):
    report = audit("t", fact, [non_empty(), no_nulls("k"), references("k", dim, "key")])
    with pytest.raises(QualityGateError) as error:
        gate(combine([report, audit("u", fact, [non_negative("amount")])]))
    assert error.value.failures == [
        "t no_nulls(k): 1 violations",
        "t references(k): 2 violations",
        "u non_negative(amount): 1 violations",
    ]
    gate(audit("t", fact, [non_empty()]))


def test_checks_need_columns(fact):
    for make in (no_nulls, non_negative, unique):
        with pytest.raises(ValueError):
            make()
    with pytest.raises(ValueError):
        audit("t", fact, [])


def test_dedup_sends_one_row_per_key_and_task(spark):
    """A third of the rows share a key: the map tasks reduce them before the shuffle."""
    df = spark.range(30_000, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    result = dedup(df, ["k"])
    plan = plan_of(result)
    assert plan.split("\n\n")[0].count("WindowGroupLimit") == 2
    assert result.count() == 20_001
    assert result.where("k = 0").first().v == 0
    assert dedup(df, ["k"], [F.desc("v")]).where("k = 0").first().v == 29_997


def test_dedup_of_whole_rows(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a")], "k int, t string")
    assert dedup(df, ["k", "t"]).count() == 2
    with pytest.raises(ValueError):
        dedup(df, [])
