import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from smeltery.operators import (
    apply_rules,
    cast_losses,
    conform,
    conform_and_filter,
    stamp_ingested,
    union_conformed,
)
from smeltery.session import overriding
from smeltery.sources import (
    list_periods,
    period_path,
    read_csv_strings,
    read_period,
    read_periods,
)

COLUMNS = [("id", "bigint"), ("n", "bigint"), ("x", "double")]


@pytest.fixture
def drifting(spark, tmp_path):
    """Five periods with four sets of physical types, one of them under other letter case."""
    frames = {
        "2023-01": "SELECT CAST(id AS INT) AS id, id % 5 AS n, CAST(id AS DOUBLE) AS x, 'e' AS e "
        "FROM range(10)",
        "2023-02": "SELECT id, CAST(id % 5 AS DOUBLE) AS n, CAST(id AS DOUBLE) AS x FROM range(10, 20)",
        "2023-03": "SELECT CAST(id AS DOUBLE) AS x, id, CAST(id % 5 AS INT) AS n FROM range(20, 30)",
        "2023-04": "SELECT id AS ID, CAST(id % 5 AS DOUBLE) AS N, CAST(id AS DOUBLE) AS X FROM range(30, 40)",
        "2023-05": "SELECT id, CAST(id % 5 AS STRING) AS n, CAST(id AS FLOAT) AS x FROM range(40, 50)",
    }
    paths = []
    for period, sql in frames.items():
        path = period_path(str(tmp_path), "yellow", period)
        spark.sql(sql).write.parquet(path)
        paths.append(path)
    return paths


def test_periods_of_any_type_come_together(spark, drifting):
    df = read_periods(spark, drifting, COLUMNS)
    assert df.dtypes == COLUMNS
    assert sorted(map(tuple, df.collect())) == [(i, i % 5, float(i)) for i in range(50)]


def test_periods_of_equal_types_share_a_scan(spark, drifting):
    plan = read_periods(spark, drifting * 3, COLUMNS)._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("Relation [") == 4


def test_one_period(spark, drifting):
    assert read_period(spark, drifting[1], COLUMNS).agg(F.sum("n")).first()[0] == 20


def test_periods_are_listed_by_file(spark, drifting, tmp_path):
    listed = list_periods(spark, str(tmp_path), "yellow")
    assert sorted({p.rsplit("/", 2)[1] for p in listed}) == [p.rsplit("/", 1)[1] for p in drifting]
    assert all(p.endswith(".parquet") and "/part-" in p for p in listed)
    assert sorted(map(tuple, read_periods(spark, listed, COLUMNS).collect())) == [
        (i, i % 5, float(i)) for i in range(50)
    ]


def test_missing_column_is_an_error(spark, drifting):
    with pytest.raises(ValueError, match="other"):
        read_periods(spark, drifting, [*COLUMNS, ("other", "int")])
    with pytest.raises(AnalysisException):
        conform(spark.range(1), [("other", "int")])


def test_case_counts_where_the_session_says_so(spark, drifting):
    with overriding(spark, {"spark.sql.caseSensitive": "true"}):
        assert read_periods(spark, drifting[:3], COLUMNS).count() == 30
        with pytest.raises(ValueError, match="2023-04"):
            read_periods(spark, drifting, COLUMNS)


def test_no_periods_is_an_error(spark):
    for attempt in (lambda: read_periods(spark, [], COLUMNS), lambda: union_conformed([])):
        with pytest.raises(ValueError):
            attempt()


def test_union_is_strict_about_columns(spark):
    with pytest.raises(AnalysisException):
        union_conformed([spark.range(1), spark.range(1).withColumnRenamed("id", "other")])


def test_values_that_do_not_fit_become_null_and_are_counted(spark):
    df = spark.sql(
        """SELECT * FROM VALUES
        ('12', CAST('NaN' AS DOUBLE), 1L),
        ('7.9', 7.9D, 4294967296L),
        ('abc', CAST('Infinity' AS DOUBLE), -1L),
        (' -3. ', -7.9D, NULL),
        ('.5', 0.5D, 0L),
        (NULL, NULL, 2147483647L) AS t(s, d, b)"""
    )
    spec = [("s", "int"), ("d", "bigint"), ("b", "int")]
    assert [tuple(r) for r in conform(df, spec).collect()] == [
        (12, None, 1),
        (7, 7, None),
        (None, None, -1),
        (-3, -7, None),
        (0, 0, 0),
        (None, None, 2147483647),
    ]
    losses = {r.column_name: r.lost_values for r in cast_losses(df, spec).collect()}
    assert losses == {"s": 1, "d": 2, "b": 1}


def test_range_ends(spark):
    doubles = [2147483647.9, 2147483648.0, -2147483648.9, -2147483649.0, 2.0**63, -(2.0**63), 0.0]
    df = spark.createDataFrame([(v,) for v in doubles], "d double")
    got = [tuple(r) for r in conform(df, [("d", "i", "int"), ("d", "b", "bigint")]).collect()]
    assert got == [
        (2147483647, 2147483647),
        (None, 2147483648),
        (-2147483648, -2147483648),
        (None, -2147483649),
        (None, None),
        (None, -(2**63)),
        (0, 0),
    ]
    whole = spark.createDataFrame([(v,) for v in (127, 128, -128, -129, None)], "v bigint")
    assert [r.v for r in conform(whole, [("v", "tinyint")]).collect()] == [127, None, -128, None, None]


def test_rename_and_keep_type(spark):
    df = conform(spark.range(2), [("id", "key", None), ("id", "small", "int")])
    assert df.dtypes == [("key", "bigint"), ("small", "int")]


@pytest.mark.parametrize("kind", ["int", "bigint", "float", "double", "string"])
@pytest.mark.parametrize("target", ["tinyint", "int", "bigint", "double"])
def test_filtering_early_changes_nothing(spark, kind, target):
    """Rules on raw columns plus rules after the cast keep what rules after the cast keep."""
    values = "0, -1, 1, 127, 128, 200"
    if kind == "bigint":
        values += ", 2147483647, 2147483648, 9007199254740993"
    if kind in ("float", "double"):
        values += ", -0.5, 0.5, 1.9, CAST('NaN' AS DOUBLE), 1e300"
    if kind == "string":
        values += ", 'abc', '0.5', '1.9'"
    if kind == "float":
        values = values.replace(", 1e300", "")
    literals = ", ".join(f"(CAST({v.strip()} AS {kind}))" for v in values.split(", "))
    df = spark.sql(f"SELECT * FROM VALUES {literals}, (NULL) AS t(v)")
    spec, rules = [("v", "w", target)], {"positive": "w > 0", "limit": "w <= 9007199254740992"}
    early = conform_and_filter(df, spec, rules)
    late = apply_rules(conform(df, spec), rules)
    assert early.dtypes == late.dtypes
    assert sorted(map(tuple, early.collect())) == sorted(map(tuple, late.collect()))


def test_computed_rules_wait_for_the_cast(spark):
    df = spark.createDataFrame([(2**62,), (3,)], "v bigint")
    rules = {"doubled": "w * 4 > 0"}  # overflows on the raw value, which the cast makes NULL
    assert [tuple(r) for r in conform_and_filter(df, [("v", "w", "int")], rules).collect()] == [(3,)]


def test_stamp_is_one_value(spark):
    df = stamp_ingested(spark.range(100, numPartitions=4))
    assert df.columns == ["id", "_ingested_at"]
    assert df.select("_ingested_at").distinct().count() == 1


def test_csv_strings(spark, tmp_path):
    path = str(tmp_path / "zones.csv")
    with open(path, "w") as out:
        out.write('LocationID,Borough,Zone\n1,EWR,"Newark, Airport"\n2,Queens,\n')
    rows = read_csv_strings(spark, path)
    assert [t for _, t in rows.dtypes] == ["string"] * 3
    assert [tuple(r) for r in rows.collect()] == [("1", "EWR", "Newark, Airport"), ("2", "Queens", None)]
    declared = read_csv_strings(spark, path, ["LocationID", "Borough", "Zone"])
    assert declared.collect() == rows.collect()
    with pytest.raises(Exception, match="header"):
        read_csv_strings(spark, path, ["LocationID", "Zone", "Borough"]).collect()
