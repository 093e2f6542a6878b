"""The layers raw, bronze, silver, gold and marts, each read from the published one before it.

Every layer is a written table, which cuts the lineage: a lost executor costs a task of the layer
at work, not the layers before. Gold and the marts are written, checked, and only then committed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import Outcomes, audit, combine, gate, non_empty, settled, stamp_ingested
from ..sinks import commit, expose, publish, read_version, stage
from ..sources import read_csv_strings, read_periods
from . import trips as T

VIEWS = {
    "fact_trips": "gold.fact_trips",
    "dim_zone": "gold.dim_zone",
    "dim_date": "gold.dim_date",
    "dim_payment_type": "gold.dim_payment_type",
    "daily_revenue": "analytics.daily_revenue",
    "top_pickup_zones": "analytics.top_pickup_zones",
    "payment_breakdown": "analytics.payment_breakdown",
}


def load_bronze(
    spark: SparkSession,
    store: str,
    period_paths: Sequence[str],
    zone_csv: str,
    columns=T.RAW_COLUMNS,
    refined_columns=T.REFINED_COLUMNS,
    rules=T.RULES,
    inventory: str | None = None,
) -> None:
    """What silver will leave out is counted while bronze is written, and published beside it."""
    landed = Outcomes(read_periods(spark, period_paths, columns, inventory), refined_columns, rules)
    publish(stamp_ingested(landed.frame), store, "bronze_trips")
    publish(T.observed_silver_report(landed).coalesce(1), store, "silver_report")
    load_zones(spark, store, zone_csv)


def load_zones(spark: SparkSession, store: str, zone_csv: str) -> None:
    """The zone file alone, as it is."""
    publish(read_csv_strings(spark, zone_csv, T.ZONE_FILE_COLUMNS), store, "bronze_zones")


def build_silver(
    spark: SparkSession,
    store: str,
    columns=T.REFINED_COLUMNS,
    rules=T.RULES,
    bronze: DataFrame | None = None,
    reported: bool = False,
) -> None:
    """From the published bronze trips, or from ``bronze`` such as an incremental ingest target.

    What the casts and the rules leave out is published beside it, and refuses nothing; with ``reported``
    the load of bronze has told it, by these columns and rules, and no scan goes into it.
    """
    if bronze is None:
        bronze = read_version(spark, store, "bronze_trips")
    if not reported:
        publish(T.silver_report(bronze, columns, rules).coalesce(1), store, "silver_report")
    publish(T.clean_trips(bronze, columns, rules), store, "silver_trips", ["pickup_date"])


def build_gold(spark: SparkSession, store: str) -> None:
    """Write fact and dimensions, check them, and make all four current at once."""
    silver = read_version(spark, store, "silver_trips")
    payments = stage(T.payment_dim(spark), store, "dim_payment_type")
    zones = stage(T.zone_dim(read_version(spark, store, "bronze_zones")), store, "dim_zone")
    # Dates come from a scan of the partition column alone, no trip data is read for them.
    dates = stage(T.trip_date_dim(silver), store, "dim_date")
    # The silver table lies by date already, so the fact is written without a shuffle.
    fact = stage(T.trip_fact(silver), store, "fact_trips", ["pickup_date"], shuffle=False)
    # One scan of the fact answers the gate's checks and the notes.
    notes = T.zone_notes(zones.frame)
    found = settled(audit("gold.fact_trips", fact.frame, [*T.fact_checks(payments.frame, dates.frame), *notes]))
    noted = (F.col("check_name") == "references") & F.col("column_name").isin([n.columns[0] for n in notes])
    report = combine([found.where(~noted), audit("gold.dim_zone", zones.frame, [non_empty()])])
    # Trips of unknown zones stay in the fact and are told here, but no mart over zones has them.
    publish(found.where(noted).coalesce(1), store, "gold_notes")
    # Stored before it is judged: the report runs once and survives a refusal.
    gate(publish(report.coalesce(1), store, "gold_report"))
    commit(spark, store, payments, zones, dates, fact)


def build_marts(spark: SparkSession, store: str) -> None:
    fact = read_version(spark, store, "fact_trips")
    staged = [
        stage(T.daily_revenue(fact), store, "daily_revenue"),
        stage(
            T.top_pickup_zones(fact, read_version(spark, store, "dim_zone")),
            store,
            "top_pickup_zones",
        ),
        stage(
            T.payment_breakdown(fact, read_version(spark, store, "dim_payment_type")),
            store,
            "payment_breakdown",
        ),
    ]
    report = combine([audit(s.table, s.frame, T.MART_CHECKS[s.table]) for s in staged])
    gate(publish(report.coalesce(1), store, "mart_report"))
    commit(spark, store, *staged)


def build_all(
    spark: SparkSession,
    store: str,
    period_paths: Sequence[str],
    zone_csv: str,
    raw_columns=T.RAW_COLUMNS,
    refined_columns=T.REFINED_COLUMNS,
    inventory: str | None = None,
) -> DataFrame:
    """All layers in order; returns the published daily mart."""
    load_bronze(spark, store, period_paths, zone_csv, raw_columns, refined_columns, inventory=inventory)
    build_silver(spark, store, refined_columns, reported=True)
    build_gold(spark, store)
    build_marts(spark, store)
    return read_version(spark, store, "daily_revenue")


def expose_views(spark: SparkSession, store: str) -> None:
    """Catalog views over the current gold tables and marts, and over the history of all tables."""
    expose(spark, store, VIEWS, "gold.snapshots")
