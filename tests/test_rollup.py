import math
import random
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from smeltery.functions import half_up_quotient, is_exact, units
from smeltery.operators import Dim, mean, rollup, row_count, total
from tests_support import plan_of

MEASURES = [row_count("n"), total("sum_x", "x"), mean("avg_x", "x")]


def cents(value: Decimal) -> float:
    return float(value.quantize(Decimal("0.01"), ROUND_HALF_UP))


def test_sums_and_means_against_decimals(spark):
    rng = random.Random(7)
    rows = [(rng.randrange(20), rng.randrange(-5_000_000, 5_000_000) / 10_000) for _ in range(20_000)]
    rows += [(99, 0.005), (99, 0.01), (98, -0.005), (98, -0.01), (97, 1.005), (96, None)]
    groups = defaultdict(list)
    for key, x in rows:
        groups[key].append(x)
    expected = {}
    for key, values in groups.items():
        exact = [Decimal(repr(v)) for v in values if v is not None]
        expected[key] = (
            len(values),
            cents(sum(exact)) if exact else None,
            cents(sum(exact) / len(exact)) if exact else None,
        )
    for parts in (1, 7):
        df = spark.createDataFrame(rows, "k int, x double").repartition(parts)
        got = {r.k: (r.n, r.sum_x, r.avg_x) for r in rollup(df, MEASURES, ["k"]).collect()}
        assert got == expected


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(-(10**15), 10**15), st.integers(1, 10**6)), min_size=1, max_size=50))
def test_half_up_quotient(spark, pairs):
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    got = [r.q for r in df.select(half_up_quotient(F.col("a"), F.col("b")).alias("q")).collect()]
    rounded = [
        (1 if a >= 0 else -1) * ((2 * abs(a) + b) // (2 * b)) for a, b in pairs
    ]
    assert got == rounded


def test_exactness_of_doubles(spark):
    exact = {0.1: 1000, 12.3456: 123456, -7.5: -75000, -12.34: -123400, 0.0: 0, 1.1e11: 1_100_000_000_000_000}
    odd = [0.1 + 0.2, 12.34567, float("nan"), float("inf"), float("-inf"), 1e300, -1e300, 2.0**60]
    df = spark.createDataFrame([(v,) for v in [*exact, *odd, None]], "x double")
    got = [tuple(r) for r in df.select(units(F.col("x")), is_exact(F.col("x"))).collect()]
    assert got[: len(exact)] == [(n, True) for n in exact.values()]
    assert [flag for _, flag in got[len(exact) :]] == [False] * len(odd) + [None]


def test_groups_with_other_values_fall_back_to_doubles(spark):
    rows = [("fine", 1 / 3)] * 2 + [("nan", float("nan")), ("nan", 1.0), ("big", 1e300), ("big", 1.0)]
    got = {
        r.k: (r.sum_x, r.avg_x)
        for r in rollup(spark.createDataFrame(rows, "k string, x double"), MEASURES, ["k"]).collect()
    }
    assert got["fine"] == (0.67, 0.33)
    assert str(got["nan"]) == "(nan, nan)"
    assert got["big"] == (1e300, 5e299)


def test_overflowing_unit_sums_fall_back(spark):
    """10,000 rows near the largest exact value overflow a bigint of units, in one step and in two."""
    rows = spark.range(10_000).select(F.lit(1).alias("k"), F.lit(1.1e11).alias("x"))
    dim = spark.sql("SELECT * FROM VALUES (1, 'a') AS t(k, name)")
    assert rollup(rows, MEASURES, ["k"]).first().sum_x == 1.1e15
    joined = rollup(rows, MEASURES, dims=[Dim(dim, "k", "k", ["name"])]).first()
    assert (joined.n, joined.sum_x) == (10_000, 1.1e15)
    many = spark.range(10_000).select(F.col("id").alias("k"), F.lit(1.1e11).alias("x"))
    wide = spark.range(10_000).select(F.col("id").alias("k"), F.lit("a").alias("name"))
    assert rollup(many, MEASURES, dims=[Dim(wide, "k", "k", ["name"])]).first().sum_x == 1.1e15


def test_totals_do_not_depend_on_the_order_of_rows(spark):
    """Noisy doubles, amounts beyond what units count, and unit sums beyond a bigint, in one group."""
    rng = random.Random(11)
    noisy = [(k % 40, rng.randrange(10**6) / 1000 + 0.005) for k in range(20_000)]
    noisy += [(k, 0.1 + 0.2) for k in range(40)] + [(1, 3.3e15), (1, -1e15 / 3), (2, 1.1e11)] + [(3, 1.1e11)] * 9000
    df = spark.createDataFrame(noisy, "k int, x double")
    dim = spark.range(40).select(F.col("id").cast("int").alias("key"), (F.col("id") % 2).alias("side"))
    seen = set()
    for parts in (1, 7, 31):
        mixed = df.repartition(parts, F.rand(parts))
        by_key = sorted(map(tuple, rollup(mixed, MEASURES, ["k"]).collect()))
        by_side = sorted(map(tuple, rollup(mixed, MEASURES, dims=[Dim(dim, "k", "key", ["side"])]).collect()))
        seen.add((tuple(by_key), tuple(by_side)))
    assert len(seen) == 1
    for k, n, sum_x, _ in next(iter(seen))[0]:
        exact = sum(Decimal(x) for key, x in noisy if key == k)
        assert abs(Decimal(sum_x) - exact) <= max(Decimal("0.0051"), abs(exact) / 10**15)


@pytest.mark.parametrize(
    "values",
    [
        [9e30] * 30 + [1e22 + 2.0**30, -3.3e25, 0.01, 1 / 3],
        [(-1) ** k * 7.7 * 10.0**e for k in range(40) for e in (-5, 2, 11, 12, 15, 19, 24, 30)] + [1e32, 5e31],
        [1.7e18, -1.7e18, 0.07, 1.2e11, -1.2e11],
        [1e300, 1.0, 3e306],
    ],
)
def test_huge_totals_neither_overflow_nor_depend_on_the_order(spark, values):
    rng = random.Random(5)
    rows = [(k % 3, v) for v in values for k in range(12)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k int, x double")
    dim = spark.range(3).select(F.col("id").cast("int").alias("key"), F.lit("a").alias("side"))
    seen = set()
    for parts in (1, 7, 31):
        mixed = df.repartition(parts, F.rand(parts))
        by_key = sorted(map(tuple, rollup(mixed, MEASURES, ["k"]).collect()))
        seen.add((*by_key, tuple(rollup(mixed, MEASURES, dims=[Dim(dim, "k", "key", ["side"])]).first())))
    assert len(seen) == 1
    for k, n, sum_x, avg_x in list(seen)[0][:3]:
        own = [Decimal(x) for key, x in rows if key == k]
        size = sum(map(abs, own))
        assert abs(Decimal(sum_x) - sum(own)) <= max(Decimal("0.0051"), size / 10**14)
        assert abs(Decimal(avg_x) - sum(own) / n) <= max(Decimal("0.0051"), size / n / 10**14)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.floats(-1e9, 1e9) | st.integers(-(10**9), 10**9).map(lambda c: c / 1000), min_size=1, max_size=30),
    st.integers(0, 4),
)
def test_rounding_against_fractions(spark, values, decimals):
    """Each value counts to 2^-25 of a unit; what is rounded is their exact sum."""
    unit = [Fraction(v) * 10**4 for v in values]
    counted = [Fraction(v * 10_000.0) for v in values]  # the product of doubles
    exact = sum(
        Fraction(math.floor(v * 10_000.0 + 0.5)) if math.floor(v * 10_000.0 + 0.5) / 10_000.0 == v
        else Fraction(math.floor(v * 10_000.0 + 0.5))
        + Fraction(math.floor((v * 10_000.0 - math.floor(v * 10_000.0 + 0.5)) * 2.0**24 + 0.5), 2**24)
        for v in values
    )
    assert abs(exact - sum(unit)) <= len(values) * (Fraction(1, 2**25) + max(abs(a - b) for a, b in zip(unit, counted)))
    measures = [total("s", "x", decimals), mean("m", "x", decimals)]
    row = rollup(spark.createDataFrame([(v,) for v in values], "x double"), measures).first()

    def away(x: Fraction) -> float:
        size = math.floor(abs(x) / 10 ** (4 - decimals) + Fraction(1, 2))
        return (-1 if x < 0 else 1) * size / 10.0**decimals

    assert (row.s, row.m) == (away(exact), away(exact / len(values)))


def test_awkward_column_names(spark):
    df = spark.sql("SELECT 1 AS `a key`, 2.5D AS `the ``value`")
    got = rollup(df, [total("the sum", "the `value"), row_count("n`")], ["a key"]).first()
    assert tuple(got) == (1, 2.5, 1)


def test_decimals_and_whole_numbers_add_up_as_they_are(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (CAST('12345678901234567.91' AS DECIMAL(20,2)), 9007199254740993L), "
        "(CAST('0.08' AS DECIMAL(20,2)), 2L) AS t(d, b)"
    )
    row = rollup(df, [total("d", "d"), total("b", "b"), mean("m", "b", 1)]).first()
    assert (str(row.d), row.b) == ("12345678901234567.99", 9007199254740995)
    assert row.m == Decimal("4503599627370497.5")


def test_nothing_matched_counts_zero(spark):
    fact = spark.range(3).select(F.col("id").alias("k"), F.lit(1.0).alias("x"))
    dim = spark.range(10, 12).select(F.col("id").alias("key"))
    row = rollup(fact, MEASURES, dims=[Dim(dim, "k", "key", [])]).first()
    assert (row.n, row.sum_x, row.avg_x) == (0, None, None)


def test_two_dimensions_with_one_attribute_name(spark):
    fact = spark.sql("SELECT * FROM VALUES (1, 2, 5.0D), (2, 2, 7.0D) AS t(a, b, x)")
    dim = spark.sql("SELECT * FROM VALUES (1, 'p'), (2, 'q') AS t(key, name)")
    got = rollup(
        fact,
        [total("s", "x")],
        dims=[Dim(dim, "a", "key", [("name", "from_name")]), Dim(dim, "b", "key", [("name", "to_name")])],
        order_by=["from_name"],
    )
    assert [tuple(r) for r in got.collect()] == [("p", "q", 5.0), ("q", "q", 7.0)]


def test_grouping_before_the_join_changes_nothing(spark):
    """Against join first, group later, with NULL keys, unmatched keys and repeated dimension keys."""
    rng = random.Random(3)
    rows = [
        (rng.choice([None, 1, 2, 3, 4]), rng.choice([1, 2, 5]), rng.randrange(100) / 4) for _ in range(3000)
    ]
    fact = spark.createDataFrame(rows, "a int, b int, x double")
    first = spark.sql("SELECT * FROM VALUES (1L,'p'),(2L,'q'),(2L,'p'),(3L,'p'),(NULL,'z') AS t(key, name)")
    second = spark.sql("SELECT * FROM VALUES (1,'u'),(2,'v') AS t(key, label)")
    got = rollup(
        fact,
        MEASURES,
        keys=["b"],
        dims=[Dim(first, "a", "key", ["name"]), Dim(second, "b", "key", ["label"])],
        order_by=["b", "name", "label"],
    )
    plain = (
        fact.join(first.withColumnRenamed("key", "k1"), F.col("a") == F.col("k1"))
        .join(second.withColumnRenamed("key", "k2"), F.col("b") == F.col("k2"))
        .groupBy("b", "name", "label")
        .agg(
            F.count("*").alias("n"),
            F.round(F.sum("x"), 2).alias("sum_x"),
            F.round(F.avg("x"), 2).alias("avg_x"),
        )
        .orderBy("b", "name", "label")
    )
    assert got.collect() == plain.collect()
    assert got.count() > 3


def test_the_join_sees_grouped_rows(spark):
    """With broadcasts off, too, the fact is aggregated below the join."""
    fact = spark.range(1000).select((F.col("id") % 7).alias("a"), F.lit(1.0).alias("x"))
    dim = spark.range(7).select(F.col("id").alias("key"), F.lit("n").alias("name"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = rollup(fact, MEASURES, dims=[Dim(dim, "a", "key", ["name"])])
        plan = plan_of(df).split("\n\n")[0]
        assert df.first().n == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("HashAggregate") == 4
    # Grouped by the join key, the fact needs no further shuffle: one per side, one for the result.
    assert plan.count("Exchange") == 3


def test_whole_table_rollup_and_bad_decimals(spark):
    df = spark.range(4).select(F.col("id").cast("double").alias("x"))
    assert tuple(rollup(df, MEASURES).first()) == (4, 6.0, 1.5)
    empty = rollup(df.where("x > 9"), MEASURES).first()
    assert (empty.n, empty.sum_x, empty.avg_x) == (0, None, None)
    with pytest.raises(ValueError):
        rollup(df, [total("t", "x", 5)])
