"""Every registered query against DuckDB on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from oracle_check import differences, duck
from smeltery.plans import bindings, oracle
from smeltery.session import overriding

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the test tables")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_its_sql():
    assert set(bindings.QUERIES) == set(oracle.SQL)
    assert set(bindings.QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(bindings.QUERIES))
def test_query_matches_sql(spark, con, name):
    assert differences(con, entry.oracle_sql()[name], entry.queries()[name](spark, SF_DIR)) == []


@pytest.mark.parametrize(
    "name", ["daily_revenue", "top_pickup_zones", "payment_breakdown", "trips_by_borough", "trips_between_boroughs"]
)
def test_ordered_queries_come_in_order(spark, con, name):
    df = bindings.QUERIES[name](spark, SF_DIR)
    order = {"trips_between_boroughs": " ORDER BY pickup_borough, dropoff_borough"}.get(name, "")
    assert "ORDER BY" in oracle.SQL[name] + order
    expected = con.sql(f"SELECT {', '.join(df.columns)} FROM ({oracle.SQL[name]}) {order}").fetchall()
    assert [tuple(r) for r in df.collect()] == expected


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["pickup_date", "trip_count"]
    assert df.count() == 876


def test_lines_are_not_shuffled_for_their_customers(spark, tmp_path):
    columns = {
        "lineitem": "l_orderkey, l_partkey, l_suppkey, 1 l_linenumber, 2D l_quantity, 3D l_extendedprice, 0D l_discount, "
        "0D l_tax, timestamp_ntz'1995-01-02' l_shipdate",
        "orders": "l_orderkey o_orderkey, l_partkey o_custkey, timestamp_ntz'1995-01-01' o_orderdate, '1-X' o_orderpriority",
        "customer": "l_partkey c_custkey, 4 c_nationkey",
        "supplier": "l_suppkey s_suppkey, 5 s_nationkey",
    }
    for name, picked in columns.items():
        rows = spark.range(3).selectExpr("id l_orderkey", "id + 10 l_partkey", "id + 20 l_suppkey")
        rows.selectExpr(*picked.split(", ")).write.parquet(f"{tmp_path}/{name}.parquet")
    with overriding(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        trips = bindings.raw_trips(spark, str(tmp_path))
        plan = trips._jdf.queryExecution().optimizedPlan().toString().splitlines()
        assert trips.count() == 3
    depth = {key: next(line.index("Join") for line in plan if "Join" in line and key in line) for key in ("l_orderkey", "c_custkey")}
    assert depth["c_custkey"] > depth["l_orderkey"]
