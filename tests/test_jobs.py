import pytest

from smeltery import jobs
from smeltery.session import work_folder
from smeltery.sinks import read_version
from smeltery.sources import period_path
from trip_rows import at, frame, trip


@pytest.fixture
def raw(spark, tmp_path):
    path = period_path(str(tmp_path / "raw"), "yellow", "2021-09")
    frame(spark, [trip(at(8), at(9)), trip(at(8), at(9)), trip(at(9), at(10))]).write.parquet(path)
    zones = tmp_path / "zones.csv"
    zones.write_text("LocationID,Borough,Zone,service_zone\n41,Queens,Astoria,Boro\n")
    return str(tmp_path / "raw"), str(zones)


def test_steps_one_by_one_and_at_once(spark, raw):
    landed, zones = raw
    source = ["--raw", landed, "--periods", " 2021-09, ", "--zones", zones]
    one, two = work_folder(spark, "store"), work_folder(spark, "store")
    assert jobs.main(["bronze", "--store", one, *source]) == 0
    for step in ("silver", "gold", "marts", "views"):
        assert jobs.main([step, "--store", one]) == 0
    assert jobs.main(["all", "--store", two, *source]) == 0
    for store in (one, two):
        assert read_version(spark, store, "daily_revenue").first().trip_count == 2


def test_incremental_path_and_refusal(spark, raw, capsys):
    landed, zones = raw
    store, target, offsets = (work_folder(spark, n) for n in ("store", "target", "offsets"))
    ingest = ["ingest", "--raw", landed, "--target", target, "--checkpoint", offsets]
    silver = ["silver", "--store", store, "--ingested", target]
    assert jobs.main(["zones", "--store", store, "--zones", zones]) == 0
    # Files of another dataset land beside ours and are none of our business.
    spark.range(3).write.parquet(period_path(landed, "green", "2021-09"))
    for step in (silver, ingest, silver, ingest, silver):
        assert jobs.main(step) == 0
    assert read_version(spark, store, "silver_trips").count() == 2
    for step in ("gold", "marts"):
        assert jobs.main([step, "--store", store]) == 0
    assert read_version(spark, store, "daily_revenue").first().trip_count == 2
    frame(spark, [trip(at(11), at(12), payment_type=8)]).write.parquet(period_path(landed, "yellow", "2021-10"))
    for step in (ingest, silver):
        assert jobs.main(step) == 0
    assert jobs.main(["gold", "--store", store]) == 1
    assert "FAIL gold.fact_trips references(payment_type): 1 violations" in capsys.readouterr().out


def test_no_periods(spark, raw):
    with pytest.raises(ValueError):
        jobs.main(["all", "--store", "x", "--raw", raw[0], "--periods", " ,", "--zones", raw[1]])
