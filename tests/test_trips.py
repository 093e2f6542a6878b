import pytest
from pyspark.sql import functions as F

from smeltery.operators import add_duration, apply_rules, conform, rule_rejects
from smeltery.plans import trips as T
from tests_support import plan_of
from trip_rows import at, frame, trip


@pytest.mark.parametrize(
    ("changes", "kept"),
    [
        ({"tpep_dropoff_datetime": at(23, 15, 1)}, True),
        ({"tpep_dropoff_datetime": at(23, 15)}, False),
        ({"tpep_dropoff_datetime": at(23, 14, 59)}, False),
        ({"trip_distance": 1e-9}, True),
        ({"trip_distance": 0.0}, False),
        ({"trip_distance": -2.5}, False),
        ({"fare_amount": 0.0}, True),
        ({"fare_amount": -0.01}, False),
        ({"total_amount": 0.0}, True),
        ({"total_amount": -31.0}, False),
        ({"passenger_count": 1}, True),
        ({"passenger_count": 0}, False),
        ({"passenger_count": -4}, False),
    ],
)
def test_each_rule_at_and_beside_its_bound(spark, changes, kept):
    rows = [trip(at(23, 15), at(23, 58), **changes)]
    assert T.clean_trips(frame(spark, rows)).count() == kept


def test_copies_and_near_copies_by_key(spark):
    one = trip(at(6), at(6, 40))
    other_key = [trip(at(6), at(6, 40), **{name: 8}) for name in ("VendorID", "PULocationID", "DOLocationID")]
    later = [trip(at(6, 0, 1), at(6, 40)), trip(at(6), at(6, 40, 1))]
    same_key = [trip(at(6), at(6, 40), payment_type=4), trip(at(6), at(6, 40), distance=1.0)]
    cleaned = T.clean_trips(frame(spark, [one, one, one, *other_key, *later, *same_key]))
    assert cleaned.count() == 6


@pytest.mark.parametrize(
    ("dropoff", "minutes"),
    [(at(13, 7, 45), 7.75), (at(13, 0, 3), 0.05), (at(2, day=18), 780.0), (at(13, month=10), 43200.0)],
)
def test_minutes_and_date_of_a_trip(spark, dropoff, minutes):
    row = T.clean_trips(frame(spark, [trip(at(13), dropoff)])).first()
    assert (row.trip_duration_minutes, row.pickup_date.isoformat()) == (minutes, "2021-09-17")


def test_payment_descriptions(spark):
    dim = T.payment_dim(spark)
    assert dim.dtypes == T.PAYMENT_COLUMNS
    assert sorted(map(tuple, dim.collect())) == T.PAYMENT_TYPES


def test_payment_dimension_has_a_known_size(spark):
    size = T.payment_dim(spark)._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    assert size < 10_000


def test_fact_key_and_columns(spark):
    fact = T.trip_fact(T.clean_trips(frame(spark, [trip(at(8), at(8, 20))])))
    assert fact.columns == ["date_key", *T.FACT_COLUMNS]
    assert fact.first().date_key == 20210917
    types = dict(fact.dtypes)
    assert (types["date_key"], types["payment_type"], types["pickup_date"]) == ("int", "int", "date")


@pytest.mark.parametrize(
    "changes",
    [
        {"tpep_pickup_datetime": None},
        {"tpep_dropoff_datetime": None},
        {"trip_distance": None},
        {"fare_amount": None},
        {"total_amount": None},
        {"passenger_count": None},
        {"passenger_count": 0},
        {"total_amount": -0.01},
        {"passenger_count": 2**40},  # does not fit the refined type
    ],
)
def test_a_rule_column_that_is_null_or_out_of_range_rejects(spark, changes):
    rows = [trip(at(8), at(8, 20), **changes)]
    assert T.clean_trips(frame(spark, rows)).count() == 0


def test_nan_passes_unless_asked_for(spark):
    raw = frame(spark, [trip(at(8), at(8, 20), distance=float("nan"))])
    assert T.clean_trips(raw).count() == 1
    assert T.clean_trips(raw, rules={**T.RULES, **T.NAN_RULES}).count() == 0


def test_columns_outside_the_rules_may_be_null(spark):
    rows = [trip(at(8), at(8, 20), payment_type=None, tip_amount=None, VendorID=None)]
    row = T.clean_trips(frame(spark, rows)).first()
    assert row.payment_type is None and row.tip_amount is None and row.vendor_id is None


def test_conflicting_copies_keep_the_same_row_in_any_order(spark):
    rows = [trip(at(8), at(8, 20), fare=float(f), payment_type=p) for f, p in [(9, 2), (7, 1), (8, 3)]]
    kept = {
        T.clean_trips(frame(spark, order).repartition(n)).first().fare_amount
        for order in (rows, rows[::-1])
        for n in (1, 3)
    }
    assert kept == {7.0}


def test_null_keys_equal_each_other(spark):
    rows = [trip(at(8), at(8, 20), PULocationID=None)] * 2
    assert T.clean_trips(frame(spark, rows)).count() == 1


def test_range_rules_reach_the_scan(spark, tmp_path):
    frame(spark, [trip(at(8), at(8, 20))]).write.parquet(str(tmp_path / "raw"))
    plan = plan_of(T.clean_trips(spark.read.parquet(str(tmp_path / "raw"))))
    assert "GreaterThan(passenger_count,0)" in plan
    assert "GreaterThan(trip_distance,0.0)" in plan
    assert "GreaterThanOrEqual(fare_amount,0.0)" in plan


def test_rejects_by_rule(spark):
    rows = [
        trip(at(8), at(8, 20)),
        trip(at(9), at(9, 10), distance=0.0),
        trip(at(10), at(9), distance=0.0),
        trip(at(11), None),
    ]
    counts = {
        r.rule_name: (r.rejected_rows, r.total_rows)
        for r in rule_rejects(conform(frame(spark, rows), T.REFINED_COLUMNS), T.RULES).collect()
    }
    assert list(counts) == list(T.RULES)
    assert counts["distance_positive"] == (2, 4)
    assert counts["pickup_before_dropoff"] == (2, 4)
    assert counts["dropoff_known"] == (1, 4)
    assert counts["fare_not_negative"] == (0, 4)


def test_rules_must_be_given(spark):
    with pytest.raises(ValueError):
        apply_rules(spark.range(1), {})


def test_date_dimension(spark):
    rows = [trip(at(8, day=d), at(9, day=d)) for d in (1, 1, 2)]
    dim = T.trip_date_dim(T.clean_trips(frame(spark, rows))).orderBy("date_key").collect()
    assert [(r.date_key, r.year, r.month, r.day, r.day_of_week) for r in dim] == [
        (20210901, 2021, 9, 1, 4),
        (20210902, 2021, 9, 2, 5),
    ]


def test_date_dimension_skips_null(spark):
    days = spark.sql("SELECT CAST(NULL AS DATE) AS pickup_date")
    assert T.trip_date_dim(days).count() == 0


def test_durations_ignore_the_session_zone_for_zoneless_times(spark):
    df = spark.sql(
        "SELECT TIMESTAMP_NTZ'2023-03-12 01:30:00.9' AS a, TIMESTAMP_NTZ'2023-03-12 03:30:01.1' AS b, "
        "TIMESTAMP_NTZ'1969-12-31 23:59:59.5' AS c"
    )
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = add_duration(df, "a", "b", "d", "m").withColumn("x", F.lit(1)).first()
        early = add_duration(df, "c", "a", "d", "m").first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    # Sub-seconds are cut at both ends; the clock change of that night does not count.
    assert row.m == (2 * 3600 + 1) / 60.0
    assert early.d.isoformat() == "1969-12-31"
    assert early.m == (1678584600 + 1) / 60.0


def test_mart_order_and_numbers(spark):
    rows = [
        trip(at(8, day=1), at(9, day=1), fare=10.0, distance=1.0, tip_amount=0.5),
        trip(at(9, day=1), at(10, day=1), fare=20.0, distance=2.0, tip_amount=0.25),
        trip(at(8, day=2), at(9, day=2), fare=1.0, distance=4.0, payment_type=9, PULocationID=7),
    ]
    trips = T.clean_trips(frame(spark, rows))
    daily = [tuple(r) for r in T.daily_revenue(trips).collect()]
    assert [(str(r[0]), *r[1:]) for r in daily] == [
        ("2021-09-01", 2, 39.5, 0.75, 19.75, 1.5),
        ("2021-09-02", 1, 5.75, 3.5, 5.75, 4.0),
    ]
    zones = spark.createDataFrame(
        [(41, "B", "Z", "s"), (8, "C", "Y", "s")],
        "location_id int, borough string, zone string, service_zone string",
    )
    assert [tuple(r) for r in T.top_pickup_zones(trips, zones).collect()] == [("B", "Z", 2, 39.5)]
    # The unknown code 9 has no description, and an inner join leaves it out.
    assert [tuple(r) for r in T.payment_breakdown(trips, T.payment_dim(spark)).collect()] == [
        ("Cash", 2, 39.5, 0.38)
    ]
