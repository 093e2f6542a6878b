"""The registered queries: every operator bound to the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import units
from ..operators import (
    add_duration,
    Dim,
    attribute_dim,
    audit,
    cast_losses,
    combine,
    conform,
    conform_and_filter,
    dedup,
    duplicates,
    no_nulls,
    non_empty,
    non_negative,
    orphans,
    mean,
    references,
    rollup,
    row_count,
    rule_rejects,
    total,
    unique,
)
from ..session import work_folder
from ..sinks import (
    ensure_namespace,
    expose,
    history,
    materialise,
    partitioned_writer,
    publish,
    read_version,
    replace_partitions,
    replace_table,
)
from ..sources import (
    count_rows,
    declare_sources,
    list_periods,
    read_csv_strings,
    read_periods,
    read_table,
)
from ..streaming import ingest_new_files, read_ingested
from . import layers
from . import trips as T

# The driver tables hold zone-less timestamps: the trip columns keep that type.
_NTZ = "timestamp_ntz"
RAW_COLUMNS = [(n, _NTZ if t == "timestamp" else t) for n, t in T.RAW_COLUMNS]
REFINED_COLUMNS = [(s, n, _NTZ if t == "timestamp" else t) for s, n, t in T.REFINED_COLUMNS]

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = [
    "l_shipdate",
    "l_partkey",
    "l_suppkey",
    "l_extendedprice",
    "l_quantity",
    "l_discount",
    "l_tax",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines seen as trips from the customer's nation to the supplier's.

    Orders meet their customers first: where both are too large to broadcast, that shuffles the narrow orders once more
    and not the lines, which are many and wide.
    """
    customers = table(spark, sf_dir, "customer")
    orders = table(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    price = units(F.col("l_extendedprice"), 2)
    share = units(F.col("l_discount"), 2)
    with_tax = units(1 + F.col("l_tax"), 2)
    return (
        table(spark, sf_dir, "lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.col("l_suppkey").alias("VendorID"),
            F.col("o_orderdate").alias("tpep_pickup_datetime"),
            F.col("l_shipdate").alias("tpep_dropoff_datetime"),
            (F.col("l_linenumber") - 1).cast("bigint").alias("passenger_count"),
            F.col("l_quantity").alias("trip_distance"),
            F.col("c_nationkey").cast("bigint").alias("PULocationID"),
            F.col("s_nationkey").cast("bigint").alias("DOLocationID"),
            F.substring("o_orderpriority", 1, 1).cast("bigint").alias("payment_type"),
            F.col("l_extendedprice").alias("fare_amount"),
            (price * share / F.lit(10000.0)).alias("tip_amount"),
            (price * with_tax / F.lit(10000.0)).alias("total_amount"),
        )
    )


def valid_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips that pass the rules, with date and duration."""
    valid = conform_and_filter(raw_trips(spark, sf_dir), REFINED_COLUMNS, T.RULES)
    return add_duration(valid, "pickup_at", "dropoff_at")


def zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("n_nationkey").cast("string").alias("LocationID"),
            F.col("r_name").alias("Borough"),
            F.col("n_name").alias("Zone"),
            F.concat(F.lit("zone "), F.col("n_nationkey").cast("string")).alias("service_zone"),
        )
    )


def _zones(spark, sf_dir):
    return T.zone_dim(zone_lookup(spark, sf_dir))


def normalize(spark, sf_dir):
    return conform(raw_trips(spark, sf_dir), REFINED_COLUMNS)


def clean_trips(spark, sf_dir):
    return T.clean_trips(raw_trips(spark, sf_dir), REFINED_COLUMNS)


def rejects(spark, sf_dir):
    return rule_rejects(conform(raw_trips(spark, sf_dir), REFINED_COLUMNS), T.RULES)


def _monthly_orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        (F.col("o_custkey") % 7).alias("passengers"),
        "o_totalprice",
        "o_orderdate",
        F.date_format("o_orderdate", "yyyy-MM").alias("month"),
    )


ORDER_COLUMNS = [
    ("o_orderkey", "bigint"),
    ("passengers", "bigint"),
    ("o_totalprice", "double"),
    ("o_orderdate", _NTZ),
]


def _land_drifting_months(df: DataFrame, folder: str) -> None:
    """Files of one flat folder; the years 1996 and 1997 come with other types and one more column."""
    year = F.substring("month", 1, 4)
    drifted = {
        "1996": df.withColumns({"passengers": F.col("passengers").cast("double"), "note": F.lit("x")}),
        "1997": df.withColumn("passengers", F.col("passengers").cast("int")),
    }
    rest = df.where(~year.isin(*drifted))
    for part in [rest, *[frame.where(year == y) for y, frame in drifted.items()]]:
        part.drop("month").write.mode("append").parquet(folder)


def conform_union(spark, sf_dir):
    landing = work_folder(spark, "landing")
    _land_drifting_months(_monthly_orders(spark, sf_dir), landing)
    return read_periods(spark, list_periods(spark, landing), ORDER_COLUMNS)


def lost_values(spark, sf_dir):
    """Orders cast to types that cannot hold all of their values."""
    return cast_losses(
        table(spark, sf_dir, "orders"),
        [
            ("o_custkey", "tinyint"),
            ("o_totalprice", "smallint"),
            ("o_orderpriority", "int"),
            ("o_orderkey", "bigint"),
        ],
    )


def silver_report(spark, sf_dir):
    return T.silver_report(raw_trips(spark, sf_dir), REFINED_COLUMNS)


def enrich_duration(spark, sf_dir):
    """First and last event of a user and day, sub-second times."""
    spans = (
        table(spark, sf_dir, "events")
        .groupBy("user_id", F.to_date("ts").alias("day"))
        .agg(F.min("ts").alias("first_at"), F.max("ts").alias("last_at"))
        .where("first_at < last_at")
    )
    timed = add_duration(spans, "first_at", "last_at", "event_date", "span_minutes")
    return timed.select("user_id", "event_date", "first_at", "last_at", "span_minutes")


def dedup_by_key(spark, sf_dir):
    return dedup(table(spark, sf_dir, "lineitem"), LINE_KEY, LINE_ORDER)


def dim_date(spark, sf_dir):
    return T.trip_date_dim(valid_trips(spark, sf_dir))


def dim_zone(spark, sf_dir):
    return attribute_dim(zone_lookup(spark, sf_dir), T.ZONE_COLUMNS)


def fact_table(spark, sf_dir):
    return T.trip_fact(valid_trips(spark, sf_dir))


def table_count(spark, sf_dir):
    return count_rows(T.trip_fact(valid_trips(spark, sf_dir)), "trip_count")


def daily_revenue(spark, sf_dir):
    return T.daily_revenue(valid_trips(spark, sf_dir))


def top_pickup_zones(spark, sf_dir):
    return T.top_pickup_zones(valid_trips(spark, sf_dir), _zones(spark, sf_dir))


def payment_breakdown(spark, sf_dir):
    return T.payment_breakdown(valid_trips(spark, sf_dir), T.payment_dim(spark))


def trips_by_borough(spark, sf_dir):
    return T.trips_by_borough(valid_trips(spark, sf_dir), _zones(spark, sf_dir))


def trips_between_boroughs(spark, sf_dir):
    """Two dimensions of one kind: the borough of pickup by the borough of dropoff."""
    zones = _zones(spark, sf_dir)
    return rollup(
        valid_trips(spark, sf_dir),
        [row_count("trips"), total("total_revenue", "total_amount")],
        dims=[
            Dim(zones, "pickup_location_id", "location_id", [("borough", "pickup_borough")]),
            Dim(zones, "dropoff_location_id", "location_id", [("borough", "dropoff_borough")]),
        ],
        order_by=["pickup_borough", "dropoff_borough"],
    )


def uneven_amounts(spark, sf_dir):
    """Sums of doubles of which hardly one is a whole number of any small unit."""
    third = table(spark, sf_dir, "events").withColumn("third", F.col("value") / 3)
    measures = [row_count("n"), total("total_third", "third"), mean("mean_third", "third", 3)]
    return rollup(third, measures, keys=["event_type"])


SOURCE_MODEL = """
WITH t AS (SELECT pickup_location_id, total_amount FROM fact_trips),
     z AS (SELECT location_id, borough FROM dim_zone)
SELECT z.borough, count(*) AS trip_count,
       CAST(sum(CAST(t.total_amount AS DECIMAL(18, 4))) AS DECIMAL(38, 2)) AS total_revenue
FROM t JOIN z ON t.pickup_location_id = z.location_id
GROUP BY z.borough
"""


def sql_model(spark, sf_dir):
    """A mart given as SQL text over declared sources, stored as a catalog table."""
    sources = {"fact_trips": T.trip_fact(valid_trips(spark, sf_dir)), "dim_zone": _zones(spark, sf_dir)}
    with declare_sources(spark, sources):
        stored = materialise(spark, SOURCE_MODEL, f"{_namespace(spark)}.revenue_by_borough")
    return stored.withColumn("total_revenue", F.col("total_revenue").cast("double"))


def _lines_with_nulls(spark, sf_dir):
    """The driver tables hold no NULL, so two columns get some."""
    return table(spark, sf_dir, "lineitem").select(
        F.expr("nullif(l_linenumber, 3)").alias("l_linenumber"),
        F.expr("nullif(l_returnflag, 'R')").alias("l_returnflag"),
    )


def dq_non_empty(spark, sf_dir):
    none = table(spark, sf_dir, "customer").where("c_acctbal > 1e12")
    return combine(
        [
            audit("customer", table(spark, sf_dir, "customer"), [non_empty()]),
            audit("rich_customer", none, [non_empty()]),
        ]
    )


def dq_no_nulls(spark, sf_dir):
    return audit(
        "lineitem",
        _lines_with_nulls(spark, sf_dir),
        [no_nulls("l_linenumber", "l_returnflag"), no_nulls("l_linenumber"), no_nulls("l_returnflag")],
    )


def dq_non_negative(spark, sf_dir):
    return audit(
        "customer", table(spark, sf_dir, "customer"), [non_negative("c_acctbal", "c_nationkey")]
    )


def _few_payments(spark):
    return T.payment_dim(spark).where("payment_type <= 3")


def dq_referential_integrity(spark, sf_dir):
    return audit(
        "fact_trips",
        T.trip_fact(valid_trips(spark, sf_dir)),
        [references("payment_type", _few_payments(spark), "payment_type")],
    )


def dq_orphan_keys(spark, sf_dir):
    """Orphan keys with their rows; NULL line numbers are orphans too."""
    lines = _lines_with_nulls(spark, sf_dir)
    known = table(spark, sf_dir, "part").select(F.col("p_size").alias("size")).where("size <= 4").distinct()
    return orphans(lines, known, [("l_linenumber", "size")])


def dq_unique(spark, sf_dir):
    return duplicates(table(spark, sf_dir, "lineitem"), LINE_KEY)


def _written(df: DataFrame, label: str) -> DataFrame:
    """The frame read back from the shared folder, so that several checks do not compute it anew."""
    path = work_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dq_report(spark, sf_dir):
    """The gate's checks on the gold tables, with checks that fail among them."""
    facts = _written(T.trip_fact(valid_trips(spark, sf_dir)), "fact")
    checks = T.fact_checks(_few_payments(spark), T.trip_date_dim(facts))
    return combine(
        [
            audit("fact_trips", facts, checks),
            audit(
                "dim_zone",
                _zones(spark, sf_dir),
                [non_empty(), unique("borough", "zone"), unique("borough")],
            ),
            audit("customer", table(spark, sf_dir, "customer"), [non_negative("c_acctbal")]),
        ]
    )


def mart_tests(spark, sf_dir):
    """The column tests of the three marts."""
    facts = _written(T.trip_fact(valid_trips(spark, sf_dir)), "fact")
    marts = {
        "daily_revenue": T.daily_revenue(facts),
        "top_pickup_zones": T.top_pickup_zones(facts, _zones(spark, sf_dir)),
        "payment_breakdown": T.payment_breakdown(facts, T.payment_dim(spark)),
    }
    return combine(
        [audit(name, _written(mart, name), T.MART_CHECKS[name]) for name, mart in marts.items()]
    )


def csv_dim_roundtrip(spark, sf_dir):
    path = work_folder(spark, "zones-csv")
    zone_lookup(spark, sf_dir).write.option("header", True).csv(path)
    return T.zone_dim(read_csv_strings(spark, path, T.ZONE_FILE_COLUMNS))


def _namespace(spark):
    folder = work_folder(spark, "namespace")
    name = folder.rsplit("/", 1)[1].replace("-", "_")
    ensure_namespace(spark, name, folder)
    return name


def publish_roundtrip(spark, sf_dir):
    """The fact as a catalog table, written twice."""
    name = f"{_namespace(spark)}.fact_trips"
    facts = _written(T.trip_fact(valid_trips(spark, sf_dir)), "fact")
    replace_table(facts.where("payment_type = 1"), name)
    replace_table(facts, name)
    return read_table(spark, name)


def partitioned_publish(spark, sf_dir):
    """The fact partitioned by date, one month replaced by shorter trips, read back whole."""
    name = f"{_namespace(spark)}.fact_trips"
    facts = _written(T.trip_fact(valid_trips(spark, sf_dir)), "fact")
    replace_table(facts, name, ["pickup_date"])
    month = facts.where("pickup_date BETWEEN DATE'1996-01-01' AND DATE'1996-01-31'")
    replace_partitions(month.where("trip_distance <= 25"), name)
    return read_table(spark, name).select(facts.columns)


def incremental_ingest(spark, sf_dir):
    """Months that land in two portions, ingested in three runs, the second with nothing new."""
    landing, target, checkpoint = (work_folder(spark, n) for n in ("landing", "ingested", "offsets"))
    orders = _monthly_orders(spark, sf_dir)
    for portion in ("month < '1998-01'", None, "month >= '1998-01'"):
        if portion:
            _land_drifting_months(orders.where(portion), landing)
        ingest_new_files(spark, landing, target, checkpoint, ORDER_COLUMNS, stamp=False)
    return read_ingested(spark, target)


def _two_versions(spark, sf_dir):
    store = work_folder(spark, "store")
    facts = _written(T.trip_fact(valid_trips(spark, sf_dir)), "fact")
    publish(facts.where("pickup_date < DATE'1998-01-01'"), store, "fact_trips")
    publish(facts, store, "fact_trips")
    return store


def snapshot_log(spark, sf_dir):
    log = history(spark, _two_versions(spark, sf_dir))
    return log.select("table_name", "version", "row_count")


def read_old_version(spark, sf_dir):
    return read_version(spark, _two_versions(spark, sf_dir), "fact_trips", 1)


def view_after_publish(spark, sf_dir):
    """A name that was made for the first version, read after the second."""
    store = work_folder(spark, "store")
    facts = _written(T.trip_fact(valid_trips(spark, sf_dir)).withColumn("paid", F.col("payment_type").cast("string")), "fact")
    publish(facts.where("payment_type = 1"), store, "fact_trips", ["paid"])
    view = f"{_namespace(spark)}.trips"
    expose(spark, store, {"fact_trips": view})
    publish(facts, store, "fact_trips", ["paid"])
    return spark.table(view)


def layered_daily_revenue(spark, sf_dir):
    """From landed files through every published layer to the daily mart."""
    landing, zone_csv, store = (work_folder(spark, n) for n in ("landing", "zones-csv", "store"))
    month = F.date_format("tpep_pickup_datetime", "yyyy-MM")
    trips = raw_trips(spark, sf_dir).withColumn("month", month)
    with partitioned_writer(trips, ["month"]) as out:
        out.partitionBy("month").save(landing)
    zone_lookup(spark, sf_dir).write.option("header", True).csv(zone_csv)
    return layers.build_all(
        spark, store, list_periods(spark, landing), zone_csv, RAW_COLUMNS, REFINED_COLUMNS
    )


QUERIES = {
    "normalize": normalize,
    "conform_union": conform_union,
    "cast_losses": lost_values,
    "clean_trips": clean_trips,
    "rule_rejects": rejects,
    "silver_report": silver_report,
    "enrich_duration": enrich_duration,
    "dedup_by_key": dedup_by_key,
    "dim_date": dim_date,
    "dim_zone": dim_zone,
    "fact_table": fact_table,
    "table_count": table_count,
    "daily_revenue": daily_revenue,
    "top_pickup_zones": top_pickup_zones,
    "payment_breakdown": payment_breakdown,
    "trips_by_borough": trips_by_borough,
    "trips_between_boroughs": trips_between_boroughs,
    "uneven_amounts": uneven_amounts,
    "sql_model": sql_model,
    "dq_non_empty": dq_non_empty,
    "dq_no_nulls": dq_no_nulls,
    "dq_non_negative": dq_non_negative,
    "dq_referential_integrity": dq_referential_integrity,
    "dq_orphan_keys": dq_orphan_keys,
    "dq_unique": dq_unique,
    "dq_report": dq_report,
    "mart_tests": mart_tests,
    "csv_dim_roundtrip": csv_dim_roundtrip,
    "publish_roundtrip": publish_roundtrip,
    "partitioned_publish": partitioned_publish,
    "incremental_ingest": incremental_ingest,
    "snapshot_log": snapshot_log,
    "read_old_version": read_old_version,
    "view_after_publish": view_after_publish,
    "layered_daily_revenue": layered_daily_revenue,
}
