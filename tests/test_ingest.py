import os
import shutil
import time

import pytest

from smeltery.session import work_folder
from smeltery.sources import list_periods, read_periods
from smeltery.streaming import ingest_new_files, read_ingested

COLUMNS = [("id", "bigint"), ("n", "bigint")]


@pytest.fixture
def places(spark):
    return [work_folder(spark, n) for n in ("landing", "target", "offsets")]


def land(spark, folder, name, first, last, kind="bigint"):
    ids = spark.range(first, last, numPartitions=1)
    df = ids.selectExpr("id", f"CAST(id % 7 AS {kind}) AS n", "'x' AS extra")
    df.write.parquet(f"{folder}/{name}")


def ids(spark, target):
    return sorted(r.id for r in read_ingested(spark, target).collect())


def test_files_are_taken_exactly_once(spark, places):
    landing, target, offsets = places
    land(spark, landing, "a", 0, 5)
    land(spark, landing, "b", 5, 8, "double")
    ingest_new_files(spark, landing, target, offsets, COLUMNS)
    assert ids(spark, target) == list(range(8))
    ingest_new_files(spark, landing, target, offsets, COLUMNS)
    assert ids(spark, target) == list(range(8))
    land(spark, landing, "c", 8, 12, "int")
    ingest_new_files(spark, landing, target, offsets, COLUMNS)
    got = read_ingested(spark, target)
    assert ids(spark, target) == list(range(12))
    assert got.dtypes == [*COLUMNS, ("_ingested_at", "timestamp")]
    assert {r.n for r in got.where("id IN (6, 9)").collect()} == {6, 2}


def test_small_batches_take_everything(spark, places):
    landing, target, offsets = places
    for i in range(7):
        land(spark, landing, f"f{i}", i * 10, i * 10 + 10, ["bigint", "double", "int"][i % 3])
    ingest_new_files(spark, landing, target, offsets, COLUMNS, max_files_per_batch=2, stamp=False)
    assert ids(spark, target) == list(range(70))


def flat(spark, folder, name, first, last, kind="bigint"):
    """One file under a name of its own, in a flat folder."""
    part = work_folder(spark, "part")
    spark.range(first, last, numPartitions=1).selectExpr("id", f"CAST(id % 7 AS {kind}) AS n").write.parquet(part)
    (file,) = [f for f in os.listdir(part) if f.endswith(".parquet")]
    os.makedirs(folder, exist_ok=True)
    shutil.copy(f"{part}/{file}", f"{folder}/{name}.parquet")


ODD_NAMES = ["a[1]", "a1", "b{x,y}", "bx", "c*", "cc", "d?", "dd", "e f", "g%20h", "i^j"]


def test_names_with_glob_characters(spark, places):
    landing, target, offsets = places
    for i, name in enumerate(ODD_NAMES):
        flat(spark, landing, name, 10 * i, 10 * i + 10, ["bigint", "double", "int"][i % 3])
    ingest_new_files(spark, landing, target, offsets, COLUMNS, max_files_per_batch=4)
    ingest_new_files(spark, landing, target, offsets, COLUMNS)
    assert ids(spark, target) == list(range(10 * len(ODD_NAMES)))
    whole = read_periods(spark, list_periods(spark, landing), COLUMNS)
    assert sorted(map(tuple, whole.collect())) == [(i, i % 7) for i in range(10 * len(ODD_NAMES))]


def test_a_file_without_a_column_is_named_and_nothing_is_lost(spark, places):
    landing, target, offsets = places
    flat(spark, landing, "good", 0, 5)
    flat(spark, landing, "good2", 5, 9, "double")
    part = work_folder(spark, "part")
    spark.range(0, 3, numPartitions=1).write.parquet(part)
    (file,) = [f for f in os.listdir(part) if f.endswith(".parquet")]
    shutil.copy(f"{part}/{file}", f"{landing}/short.parquet")
    with pytest.raises(Exception, match="short.parquet lacks"):
        ingest_new_files(spark, landing, target, offsets, COLUMNS)
    with pytest.raises(ValueError, match="short.parquet lacks"):
        read_periods(spark, [landing], COLUMNS)
    flat(spark, landing, "short", 9, 12)  # mended
    ingest_new_files(spark, landing, target, offsets, COLUMNS)
    assert ids(spark, target) == list(range(12))


def test_one_job_reads_all_footers(spark, places):
    landing = places[0]
    counts = []
    for n in (40, 120):
        for i in range(n):
            flat(spark, f"{landing}{n}", f"f{i}", i, i + 1) if i < 2 else shutil.copy(
                f"{landing}{n}/f1.parquet", f"{landing}{n}/f{i}.parquet"
            )
        group = f"footers-{n}"
        spark.sparkContext.setJobGroup(group, group)
        read_periods(spark, [f"{landing}{n}"], COLUMNS)
        counts.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert counts[0] == counts[1]


def test_only_the_dataset_asked_for(spark, places):
    landing, target, offsets = places
    flat(spark, f"{landing}/ours", "a", 0, 4)
    os.makedirs(f"{landing}/theirs")
    spark.range(2).selectExpr("id AS x").write.parquet(f"{landing}/theirs/b")
    ingest_new_files(spark, landing, target, offsets, COLUMNS, dataset="ours")
    assert ids(spark, target) == list(range(4))


def test_nothing_ingested_yet(spark, places):
    assert read_ingested(spark, places[1], COLUMNS).dtypes == COLUMNS
    assert read_ingested(spark, places[1], COLUMNS).count() == 0


def test_late_files_with_an_old_date_count(spark, places):
    landing, target, offsets = places
    land(spark, landing, "new", 0, 3)
    ingest_new_files(spark, landing, target, offsets, COLUMNS)
    land(spark, landing, "old", 3, 6)
    old = time.time() - 90 * 86400
    for name in os.listdir(f"{landing}/old"):
        os.utime(f"{landing}/old/{name}", (old, old))
    ingest_new_files(spark, landing, target, offsets, COLUMNS)
    assert ids(spark, target) == list(range(6))


def test_a_batch_run_again_replaces_its_output(spark, places):
    """A lost commit entry makes the stream repeat its last batch."""
    landing, target, offsets = places
    land(spark, landing, "a", 0, 5)
    ingest_new_files(spark, landing, target, offsets, COLUMNS)
    for name in ("0", ".0.crc"):
        path = f"{offsets}/commits/{name}"
        if os.path.exists(path):
            os.remove(path)
    ingest_new_files(spark, landing, target, offsets, COLUMNS)
    assert ids(spark, target) == list(range(5))
