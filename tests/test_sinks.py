import os
import subprocess
import sys
import threading
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from smeltery.session import overriding, work_folder
from smeltery.sinks import (
    commit,
    ensure_namespace,
    expose,
    history,
    materialise,
    publish,
    read_version,
    replace_partitions,
    replace_table,
    stage,
)
from smeltery.sinks import tables
from smeltery.sources import count_rows, declare_sources, read_table
from tests_support import plan_of


@pytest.fixture
def namespace(spark):
    folder = work_folder(spark, "ns")
    name = folder.rsplit("/", 1)[1].replace("-", "_")
    ensure_namespace(spark, name, folder)
    ensure_namespace(spark, name, folder)
    return name


@pytest.fixture
def days(spark):
    return spark.range(300).select(
        "id", F.date_add(F.lit("2023-01-01").cast("date"), (F.col("id") % 3).cast("int")).alias("d")
    )


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_replacing_a_table_twice_gives_the_same_table(spark, namespace, days):
    name = f"{namespace}.t"
    for _ in range(2):
        replace_table(days, name)
    assert rows(read_table(spark, name)) == rows(days)
    replace_table(days.where("id < 5"), name)
    assert count_rows(read_table(spark, name)).first().row_count == 5


def test_partitioned_table_prunes_and_reruns(spark, namespace, days):
    name = f"{namespace}.p"
    for _ in range(2):
        replace_table(days, name, ["d"])
    stored = read_table(spark, name)
    assert rows(stored.select("id", "d")) == rows(days)
    one_day = stored.where("d = DATE'2023-01-02'")
    assert one_day.count() == 100
    assert len(one_day.inputFiles()) < len(stored.inputFiles())


def test_replacing_partitions_leaves_the_others(spark, namespace, days):
    name = f"{namespace}.q"
    replace_table(days, name, ["d"])
    backfill = spark.sql("SELECT DATE'2023-01-02' AS d, -1L AS id")
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    for _ in range(2):
        replace_partitions(backfill, name)
    counts = {str(r.d): r["count"] for r in read_table(spark, name).groupBy("d").count().collect()}
    assert counts == {"2023-01-01": 100, "2023-01-02": 1, "2023-01-03": 100}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before
    replace_table(days, f"{namespace}.r")
    with pytest.raises(ValueError):
        replace_partitions(backfill, f"{namespace}.r")


@pytest.fixture
def skewed(spark):
    """Day 0 holds 42% of the rows."""
    return spark.range(400_000, numPartitions=8).select(
        "id",
        F.rand(1).alias("x"),
        F.when(F.col("id") % 5 < 2, 0).otherwise(F.col("id") % 40).cast("int").alias("day"),
    )


def rows_per_file(stored):
    named = stored.groupBy("day", F.input_file_name().alias("file")).count()
    return [(r.day, r["count"]) for r in named.collect()]


def test_hot_date_is_split_over_tasks(spark, skewed):
    """No single task writes the hot date, and no row is lost."""
    with overriding(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k"}):
        stored = publish(skewed, work_folder(spark, "store"), "skewed", ["day"])
    assert rows(stored) == rows(skewed)
    hot = [n for day, n in rows_per_file(stored) if day == 0]
    assert len(hot) > 4
    assert max(hot) < sum(hot) / 3


def test_a_table_laid_out_alike_is_copied_without_a_shuffle(spark, skewed):
    """Few files per date and a split hot date carry over, and the write has no exchange."""
    store = work_folder(spark, "store")
    with overriding(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k"}):
        first = publish(skewed, store, "first", ["day"])
    files = rows_per_file(first)
    second = stage(first.withColumn("x", F.col("x") + 0), store, "second", ["day"], shuffle=False).frame
    copied = rows_per_file(second)
    assert rows(second) == rows(skewed)
    assert len(copied) <= len(files)
    assert "Exchange" not in plan_of(first.withColumn("x", F.col("x") + 0))


def test_dates_of_common_size_get_one_file_each(spark, skewed):
    stored = publish(skewed, work_folder(spark, "store"), "even", ["day"])
    files = rows_per_file(stored)
    assert len(files) == len({day for day, _ in files}) == stored.select("day").distinct().count()


def test_sql_model_over_declared_sources(spark, namespace, days):
    with declare_sources(spark, {"declared_days": days}):
        model = "WITH s AS (SELECT d FROM declared_days) SELECT d, count(*) AS n FROM s GROUP BY d"
        assert [r.n for r in materialise(spark, model, f"{namespace}.m").collect()] == [100] * 3
        assert materialise(spark, days, f"{namespace}.n", ["d"]).count() == 300


def test_versions_are_logged_and_readable(spark, days):
    store = work_folder(spark, "store")
    assert history(spark, store).count() == 0
    with pytest.raises(ValueError):
        read_version(spark, store, "t")
    publish(days.where("id < 10"), store, "t", ["d"])
    publish(days, store, "t", ["d"])
    publish(days.limit(1), store, "other")
    log = history(spark, store, "t").orderBy("version").collect()
    assert [(r.version, r.row_count) for r in log] == [(1, 10), (2, 300)]
    assert log[0].committed_at <= log[1].committed_at
    assert rows(read_version(spark, store, "t")) == rows(days)
    assert read_version(spark, store, "t").dtypes == days.dtypes
    assert rows(read_version(spark, store, "t", 1)) == rows(days.where("id < 10"))
    assert read_version(spark, store, "t", as_of=log[0].committed_at).count() == 10
    assert read_version(spark, store, "t", as_of=log[1].committed_at).count() == 300
    with pytest.raises(ValueError):
        read_version(spark, store, "t", as_of=log[0].committed_at - timedelta(seconds=1))
    with pytest.raises(ValueError):
        read_version(spark, store, "t", 3)


def test_staged_versions_show_only_after_the_commit(spark, days):
    store = work_folder(spark, "store")
    publish(days.where("id < 10"), store, "a")
    lost = stage(days.where("id < 20"), store, "a")
    assert read_version(spark, store, "a").count() == 10
    # A rerun takes the same version number and writes over what the lost run left.
    a, b = stage(days, store, "a"), stage(days.where("id < 7"), store, "b", ["d"])
    assert a.path == lost.path
    commit(spark, store, a, b)
    assert read_version(spark, store, "a").count() == 300
    assert read_version(spark, store, "b").count() == 7
    commits = {r.path for r in history(spark, store).collect()}
    assert len(commits) == 3


def test_string_partition_values_keep_their_type(spark):
    store = work_folder(spark, "store")
    df = spark.sql("SELECT * FROM VALUES ('007', 1), ('7', 2), (NULL, 3) AS t(code, v)")
    stored = publish(df, store, "codes", ["code"])
    assert sorted(map(tuple, stored.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    assert stored.dtypes == df.dtypes


def test_string_partitions_keep_their_type_in_views(spark):
    store = work_folder(spark, "store")
    df = spark.sql("SELECT * FROM VALUES ('007', 1, 'x'), ('7', 2, 'x'), (NULL, 3, '01') AS t(code, v, b)")
    view = f"{store.rsplit('/', 1)[1].replace('-', '_')}.codes"
    publish(df, store, "codes", ["b", "code"])
    expose(spark, store, {"codes": view})
    shown = spark.table(view)
    assert shown.dtypes == df.dtypes
    assert sorted(map(tuple, shown.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    publish(df.where("v = 0"), store, "codes", ["b", "code"])
    assert spark.table(view).count() == 0


def test_a_rerun_leaves_nothing_of_a_failed_run(spark, days):
    store = work_folder(spark, "store")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        stage(days, store, "t", ["d"])
        again = stage(days.where("id < 10"), store, "t", ["d"])
        commit(spark, store, again)
        assert read_version(spark, store, "t").count() == 10
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_views_follow_the_current_version(spark, days):
    store = work_folder(spark, "store")
    view = f"{store.rsplit('/', 1)[1].replace('-', '_')}.days"
    publish(days.where("id < 10"), store, "t", ["d"])
    expose(spark, store, {"t": view})
    assert spark.sql(f"SELECT count(*) FROM {view}").first()[0] == 10
    publish(days, store, "t", ["d"])
    assert spark.sql(f"SELECT count(*) FROM {view} WHERE d = DATE'2023-01-01'").first()[0] == 100


def test_work_folder_lies_in_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = work_folder(spark, "x"), work_folder(spark, "x")
    assert one != two and os.path.dirname(one) == base


def test_a_table_stays_until_its_successor_is_written(spark, days):
    space = work_folder(spark, "space")
    name = space.rsplit("/", 1)[1].replace("-", "_")
    ensure_namespace(spark, name, space)
    for by in ([], ["d"]):
        table = f"{name}.t{len(by)}"
        replace_table(days, table, by)
        with pytest.raises(Exception, match="stop"):
            replace_table(days.withColumn("x", F.raise_error(F.lit("stop"))), table, by)
        assert spark.table(table).count() == 300
        replace_table(days.where("id < 20"), table, by)
        assert spark.table(table).count() == 20
        spark.sql(f"ALTER TABLE {table} RENAME TO {table}__old")  # as a job leaves it that dies between renames
        replace_table(days.where("id < 30"), table, by)
        assert sorted(r.id for r in spark.table(table).collect()) == list(range(30))
        assert not spark.catalog.tableExists(f"{table}__old")


def files_of(table):
    return {os.path.dirname(f).split("__data/")[1].split("/")[0] for f in table.inputFiles()}


def test_a_replacement_moves_no_data(spark, namespace, days):
    for by in ([], ["d"]):
        name = f"{namespace}.still{len(by)}"
        replace_table(days, name, by)
        first = spark.table(name).inputFiles()
        replace_table(days.where("id < 200"), name, by)
        assert files_of(spark.table(name)) == {"000002-whole"}
        # The files that were current are where they were, for their readers, until the next replacement.
        assert all(os.path.exists(f.removeprefix("file://")) for f in first)
        replace_table(days.where("id < 100"), name, by)
        assert spark.table(name).count() == 100
        assert not any(os.path.exists(f.removeprefix("file://")) for f in first)


def test_the_name_is_never_absent(spark, namespace, days):
    """A reader that looks all the time sees the old rows or the new, of a partitioned table those of each day."""
    for by in ([], ["d"]):
        name = f"{namespace}.seen{len(by)}"
        replace_table(days, name, by)
        stop, seen = threading.Event(), set()

        def look():
            while not stop.is_set():
                counts = {str(r.d): r["count"] for r in spark.table(name).groupBy("d").count().collect()}
                seen.add(tuple(sorted(counts.items())))

        reader = threading.Thread(target=look)
        reader.start()
        try:
            replace_table(days.where("id < 150"), name, by)
            replace_table(days.where("id < 90"), name, by)
        finally:
            stop.set()
            reader.join()
        assert seen and all(len(counts) == 3 and {n for _, n in counts} <= {100, 50, 30} for counts in seen)
        assert by or all(len({n for _, n in counts}) == 1 for counts in seen)


def test_a_failure_between_partitions_leaves_each_old_or_new(spark, namespace, days, monkeypatch):
    name = f"{namespace}.half"
    replace_table(days, name, ["d"])
    less = days.where("id < 30")
    for replace in (lambda: replace_partitions(less, name), lambda: replace_table(less, name, ["d"])):
        replace_table(days, name, ["d"])
        plain, calls = tables._spec, []

        def breaks(fragment):
            calls.append(fragment)
            if len(calls) > 1:
                raise RuntimeError("lost the driver")
            return plain(fragment)

        monkeypatch.setattr(tables, "_spec", breaks)
        monkeypatch.setattr(tables, "_AT_A_TIME", 1)
        with pytest.raises(RuntimeError):
            replace()
        monkeypatch.setattr(tables, "_spec", plain)
        counts = sorted(r["count"] for r in spark.table(name).groupBy("d").count().collect())
        assert counts == [10, 100, 100]
        replace()
        assert sorted(r["count"] for r in spark.table(name).groupBy("d").count().collect()) == [10, 10, 10]


def test_partitions_are_audited_before_they_show(spark, namespace, days):
    name = f"{namespace}.audited"
    replace_table(days, name, ["d"])

    def refuse(written):
        assert written.count() == 10
        assert written.columns == spark.table(name).columns
        raise ValueError("refused")

    with pytest.raises(ValueError, match="refused"):
        replace_partitions(days.where("id < 30 AND d = DATE'2023-01-01'"), name, refuse)
    assert spark.table(name).count() == 300
    replace_partitions(days.where("id < 30 AND d = DATE'2023-01-01'"), name, lambda written: None)
    assert spark.table(name).count() == 210


def test_partitions_of_any_type_come_and_go(spark, namespace):
    df = spark.sql(
        "SELECT * FROM VALUES (1, 5, 'a b/c=:%', DATE'2020-01-01', 1.50BD), (2, NULL, NULL, NULL, NULL), "
        "(3, -7, 'it''s', DATE'1999-12-31', 2.25BD) AS t(v, i, s, d, n)"
    )
    for by in (["i"], ["s"], ["d"], ["n"], ["s", "i", "n"]):
        name = f"{namespace}.by_{'_'.join(by)}"
        replace_table(df, name, by)
        replace_table(df, name, by)
        stored = spark.table(name)
        assert sorted(map(tuple, stored.select(df.columns).collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
        replace_partitions(df.where("v <> 1").withColumn("v", F.col("v") * 10), name)
        assert sorted(r.v for r in spark.table(name).collect()) == [1, 20, 30]
        replace_table(df.where("v = 3"), name, by)
        assert [r.v for r in spark.table(name).collect()] == [3]


def test_other_columns_or_partitions_make_a_new_table(spark, namespace, days):
    name = f"{namespace}.shape"
    days.limit(5).write.saveAsTable(name)  # one that keeps its files in the warehouse
    replace_table(days, name)
    replace_table(days.withColumn("x", F.lit("y")), name)
    assert spark.table(name).columns == ["id", "d", "x"]
    replace_table(days, name, ["d"])
    assert len(spark.sql(f"SHOW PARTITIONS {name}").collect()) == 3
    replace_table(days.select("d", "id"), name)
    assert rows(spark.table(name)) == rows(days.select("d", "id"))


def test_many_publishes_leave_one_table_and_one_view(spark, days):
    store = work_folder(spark, "store")
    space = store.rsplit("/", 1)[1].replace("-", "_")
    publish(days, store, "t", ["d"])
    expose(spark, store, {"t": f"{space}.days"})
    days.limit(1).write.saveAsTable(f"{space}.days_v000001x")
    days.limit(1).write.saveAsTable(f"{space}.days_v000099")  # not ours
    for n in range(10):
        publish(days.where(f"id < {n + 1}").withColumn(f"c{n % 2}", F.lit(n)), store, "t", ["d"])
        assert spark.table(f"{space}.days").count() == n + 1
    left = sorted(t.name for t in spark.catalog.listTables(space))
    assert left == ["days", "days_v000001x", "days_v000011", "days_v000099"]
    assert read_version(spark, store, "t", 1).count() == 300


def test_defaults_fill_in_what_spark_defaults_leaves_open(tmp_path):
    (tmp_path / "spark-defaults.conf").write_text(
        "spark.sql.session.timeZone America/New_York\nspark.sql.adaptive.advisoryPartitionSizeInBytes 32m\n"
        "spark.ui.enabled false\nspark.master local[1]\n"
    )
    code = (
        "from smeltery.session import build_session; s = build_session('t'); "
        "print('GOT', s.conf.get('spark.sql.session.timeZone'), "
        "s.conf.get('spark.sql.adaptive.advisoryPartitionSizeInBytes'), "
        "s.conf.get('spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled'))"
    )
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": root}
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=120)
    assert "GOT America/New_York 32m true" in out.stdout


def test_declared_sources_leave_no_views(spark):
    with declare_sources(spark, {"one_source": spark.range(3)}):
        assert spark.sql("SELECT count(*) FROM one_source").first()[0] == 3
        with pytest.raises(Exception, match="one_source"):
            with declare_sources(spark, {"one_source": spark.range(1)}):
                pass
    assert not spark.catalog.tableExists("one_source")
