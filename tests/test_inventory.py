import os
import shutil
import time

import pytest

from smeltery.session import work_folder
from smeltery.sources import inventory, inventoried, landed_files, read_inventory, read_periods
from smeltery.streaming import ingest_new_files, read_ingested

COLUMNS = [("id", "bigint"), ("n", "bigint")]


@pytest.fixture
def samples(spark):
    """One file each of three sets of types, by type of the second column."""
    found = {}
    for kind in ("bigint", "double", "int"):
        part = work_folder(spark, "part")
        spark.range(3, numPartitions=1).selectExpr("id", f"CAST(id AS {kind}) AS n").write.parquet(part)
        (found[kind],) = [f"{part}/{f}" for f in os.listdir(part) if f.endswith(".parquet")]
    return found


def test_thousands_of_files_and_only_unknown_ones_are_opened(spark, samples, monkeypatch):
    landing, folder = work_folder(spark, "landing"), work_folder(spark, "inventory")
    os.makedirs(landing)
    kinds = list(samples)
    for i in range(5000):
        shutil.copy(samples[kinds[i % 3]], f"{landing}/f{i}.parquet")
    first = read_periods(spark, [landing], COLUMNS, folder)
    assert first.count() == 15000
    assert read_inventory(spark, folder).count() == 5000
    assert read_inventory(spark, folder).select("columns").distinct().count() == 3
    # Files of another type under an old name, and new ones; the rest is not opened again.
    time.sleep(0.01)
    shutil.copy(samples["double"], f"{landing}/f0.parquet")
    shutil.copy(samples["int"], f"{landing}/late.parquet")
    opened = []
    read = inventory.with_columns
    monkeypatch.setattr(inventory, "with_columns", lambda files: opened.append(files.count()) or read(files))
    second = read_periods(spark, [landing], COLUMNS, folder)
    assert opened == [2]
    assert second.agg({"n": "sum", "id": "count"}).first().asDict() == {"sum(n)": 3 * 5001, "count(id)": 3 * 5001}
    read_periods(spark, [landing], COLUMNS, folder)
    assert opened == [2]


def test_a_file_noted_twice_or_gone_comes_back_right(spark, samples):
    landing, folder = work_folder(spark, "landing"), work_folder(spark, "inventory")
    os.makedirs(landing)
    for kind, path in samples.items():
        shutil.copy(path, f"{landing}/{kind}.parquet")
    inventoried(spark, [landing], folder)
    noted = read_inventory(spark, folder).collect()
    spark.createDataFrame(noted, inventory.STORED).write.mode("append").parquet(folder)
    os.remove(f"{landing}/int.parquet")
    found = inventoried(spark, [landing], folder)
    assert sorted(os.path.basename(r.path) for r in found.collect()) == ["bigint.parquet", "double.parquet"]
    assert found.where("columns IS NULL").count() == 0
    assert landed_files(spark, [landing]).count() == 2


def test_files_named_one_by_one_need_no_job(spark, samples):
    spark.sparkContext.setJobGroup("named", "named")
    named = read_periods(spark, [samples["double"], samples["int"]], COLUMNS)
    # Spark itself looks at one footer for each set of types.
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("named")) <= 2
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sorted(map(tuple, named.collect())) == sorted([(i, i) for i in range(3)] * 2)


def test_a_batch_that_was_written_but_not_ended_is_taken_once(spark, samples):
    landing, target, checkpoint = (work_folder(spark, n) for n in ("landing", "target", "taken"))
    os.makedirs(landing)
    for i in range(5):
        shutil.copy(samples["bigint"], f"{landing}/f{i}.parquet")
    ingest_new_files(spark, landing, target, checkpoint, COLUMNS, max_files_per_batch=2, stamp=False)
    rows = spark.read.parquet(f"{checkpoint}/taken").collect()
    assert sorted(r.ingest_batch for r in rows) == [0, 0, 1, 1, 2]
    # As if the last run had died between the rows of batch 1 and its end; another file lands meanwhile.
    shutil.rmtree(f"{checkpoint}/taken")
    spark.createDataFrame([r for r in rows if r.ingest_batch == 0], rows[0].__fields__).write.parquet(f"{checkpoint}/taken")
    shutil.copy(samples["double"], f"{landing}/e.parquet")
    ingest_new_files(spark, landing, target, checkpoint, COLUMNS, max_files_per_batch=2, stamp=False)
    assert sorted(r.id for r in read_ingested(spark, target).collect()) == sorted([0, 1, 2] * 6)
    with pytest.raises(ValueError):
        ingest_new_files(spark, landing, target, checkpoint, COLUMNS, max_files_per_batch=0)
