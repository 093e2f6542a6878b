import pytest

from smeltery.operators import QualityGateError
from smeltery.plans import layers
from smeltery.session import work_folder
from smeltery.sinks import history, read_version
from smeltery.sources import period_path
from trip_rows import at, frame, trip

ZONES = "LocationID,Borough,Zone,service_zone\n41,Queens,Astoria,Boro\n74,Bronx,Belmont,Boro\n"


@pytest.fixture
def landed(spark, tmp_path):
    """Two overlapping months, the second with a drifted type; one invalid trip."""
    first = [trip(at(8, day=d), at(9, day=d), PULocationID=(41, 74)[d % 2]) for d in (1, 2, 3)]
    second = [first[2], trip(at(8, day=1, month=10), at(9, day=1, month=10)), trip(at(9, month=10), at(8, month=10))]
    paths = [period_path(str(tmp_path), "yellow", f"2021-{m:02d}") for m in (9, 10)]
    frame(spark, first).write.parquet(paths[0])
    drifted = frame(spark, second)
    drifted.withColumn("passenger_count", drifted.passenger_count.cast("double")).write.parquet(paths[1])
    zones = tmp_path / "zones.csv"
    zones.write_text(ZONES)
    return paths, str(zones)


def test_all_layers(spark, landed):
    store = work_folder(spark, "store")
    daily = layers.build_all(spark, store, *landed).orderBy("pickup_date").collect()
    assert [(str(r.pickup_date), r.trip_count, r.total_revenue) for r in daily] == [
        ("2021-09-01", 1, 26.0),
        ("2021-09-02", 1, 26.0),
        ("2021-09-03", 1, 26.0),
        ("2021-10-01", 1, 26.0),
    ]
    zones = read_version(spark, store, "top_pickup_zones").collect()
    assert {(r.zone, r.trip_count) for r in zones} == {("Astoria", 2), ("Belmont", 2)}
    assert read_version(spark, store, "bronze_trips").columns[-1] == "_ingested_at"
    assert read_version(spark, store, "bronze_trips").count() == 6
    assert read_version(spark, store, "gold_report").where("NOT passed").count() == 0
    notes = {r.column_name: r.violations for r in read_version(spark, store, "gold_notes").collect()}
    assert notes == {"pickup_location_id": 0, "dropoff_location_id": 0}
    silver = {(r.check_name, r.column_name): r.violations for r in read_version(spark, store, "silver_report").collect()}
    assert silver["rule_reject", "pickup_before_dropoff"] == 1 and silver["cast_loss", "passenger_count"] == 0
    layers.expose_views(spark, store)
    ranking = spark.sql(
        """SELECT z.borough, count(*) AS trips FROM gold.fact_trips f
        JOIN gold.dim_zone z ON f.pickup_location_id = z.location_id
        GROUP BY z.borough ORDER BY trips DESC, z.borough"""
    )
    assert [tuple(r) for r in ranking.collect()] == [("Bronx", 2), ("Queens", 2)]
    log = spark.sql("SELECT * FROM gold.snapshots WHERE table_name = 'fact_trips'").collect()
    assert [(r.version, r.row_count) for r in log] == [(1, 4)]
    assert spark.sql("SELECT sum(trip_count) FROM analytics.payment_breakdown").first()[0] == 4


def test_rerun_gives_the_same_tables(spark, landed):
    store = work_folder(spark, "store")
    for _ in range(2):
        layers.build_all(spark, store, *landed)
    for name in layers.VIEWS:
        one, two = (read_version(spark, store, name, v) for v in (1, 2))
        assert one.count() > 0
        assert one.exceptAll(two).count() == two.exceptAll(one).count() == 0


def test_a_bad_load_never_reaches_gold(spark, landed, tmp_path):
    store = work_folder(spark, "store")
    paths, zones = landed
    layers.build_all(spark, store, paths, zones)
    bad = period_path(str(tmp_path), "yellow", "2021-11")
    frame(spark, [trip(at(8, month=11), at(9, month=11), payment_type=9)]).write.parquet(bad)
    with pytest.raises(QualityGateError) as error:
        layers.build_all(spark, store, [*paths, bad], zones)
    assert error.value.failures == ["gold.fact_trips references(payment_type): 1 violations"]
    assert read_version(spark, store, "fact_trips").count() == 4
    assert history(spark, store, "fact_trips").count() == 1
    # The report of the refused load is kept.
    assert read_version(spark, store, "gold_report", 2).where("NOT passed").count() == 1
