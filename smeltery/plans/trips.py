"""Declarations for the trip data set: schemas, rules, keys, checks and marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import (
    Dim,
    Outcomes,
    add_duration,
    attribute_dim,
    conform_and_filter,
    date_dim,
    dedup,
    fact,
    losses_and_rejects,
    mean,
    no_nulls,
    non_empty,
    non_negative,
    references,
    rollup,
    row_count,
    static_dim,
    total,
    unique,
)

# The published column names and types of the raw trip files.
RAW_COLUMNS = [
    ("VendorID", "bigint"),
    ("tpep_pickup_datetime", "timestamp"),
    ("tpep_dropoff_datetime", "timestamp"),
    ("passenger_count", "bigint"),
    ("trip_distance", "double"),
    ("PULocationID", "bigint"),
    ("DOLocationID", "bigint"),
    ("payment_type", "bigint"),
    ("fare_amount", "double"),
    ("tip_amount", "double"),
    ("total_amount", "double"),
]

# Refined names and types (source, target, type).
REFINED_COLUMNS = [
    ("VendorID", "vendor_id", None),
    ("tpep_pickup_datetime", "pickup_at", "timestamp"),
    ("tpep_dropoff_datetime", "dropoff_at", "timestamp"),
    ("passenger_count", "passenger_count", "int"),
    ("trip_distance", "trip_distance", "double"),
    ("PULocationID", "pickup_location_id", "int"),
    ("DOLocationID", "dropoff_location_id", "int"),
    ("payment_type", "payment_type", "int"),
    ("fare_amount", "fare_amount", "double"),
    ("tip_amount", "tip_amount", "double"),
    ("total_amount", "total_amount", "double"),
]

# What makes a trip valid.
RULES = {
    "pickup_known": "pickup_at IS NOT NULL",
    "dropoff_known": "dropoff_at IS NOT NULL",
    "pickup_before_dropoff": "pickup_at < dropoff_at",
    "distance_positive": "trip_distance > 0",
    "fare_not_negative": "fare_amount >= 0",
    "total_not_negative": "total_amount >= 0",
    "passengers_positive": "passenger_count > 0",
}

# Optional and off by default: NaN counts as greater than any number, so it passes the rules above.
NAN_RULES = {
    "distance_is_number": "NOT isnan(trip_distance)",
    "fare_is_number": "NOT isnan(fare_amount)",
    "total_is_number": "NOT isnan(total_amount)",
}

# The key of a trip.
TRIP_KEY = ["vendor_id", "pickup_at", "dropoff_at", "pickup_location_id", "dropoff_location_id"]

# The columns of the fact table behind its date key.
FACT_COLUMNS = [
    "pickup_date",
    "pickup_location_id",
    "dropoff_location_id",
    "payment_type",
    "passenger_count",
    "trip_distance",
    "trip_duration_minutes",
    "fare_amount",
    "tip_amount",
    "total_amount",
]

# Payment codes.
PAYMENT_TYPES = [
    (1, "Credit card"),
    (2, "Cash"),
    (3, "No charge"),
    (4, "Dispute"),
    (5, "Unknown"),
    (6, "Voided trip"),
]
PAYMENT_COLUMNS = [("payment_type", "bigint"), ("payment_description", "string")]

# Header of the zone file and the dimension made of it.
ZONE_FILE_COLUMNS = ["LocationID", "Borough", "Zone", "service_zone"]
ZONE_COLUMNS = [
    ("LocationID", "location_id", "int"),
    ("Borough", "borough", None),
    ("Zone", "zone", None),
    ("service_zone", "service_zone", None),
]


def clean_trips(raw: DataFrame, columns=REFINED_COLUMNS, rules=RULES) -> DataFrame:
    """Raw trips to refined trips: rename, cast, filter, derive date and duration, one row per key."""
    valid = conform_and_filter(raw, columns, rules)
    # Equal trips first settle on the survivor, so only surviving rows pay for derived columns.
    return add_duration(dedup(valid, TRIP_KEY), "pickup_at", "dropoff_at")


def payment_dim(spark: SparkSession) -> DataFrame:
    return static_dim(spark, PAYMENT_TYPES, PAYMENT_COLUMNS)


def zone_dim(lookup: DataFrame) -> DataFrame:
    return attribute_dim(lookup, ZONE_COLUMNS)


def trip_date_dim(trips: DataFrame) -> DataFrame:
    return date_dim(trips, "pickup_date")


def trip_fact(trips: DataFrame) -> DataFrame:
    return fact(trips, "pickup_date", FACT_COLUMNS)


def daily_revenue(trips: DataFrame) -> DataFrame:
    """Per day. ``avg_fare`` is, as its readers know it, the average of the total amount."""
    return rollup(
        trips,
        [
            row_count("trip_count"),
            total("total_revenue", "total_amount"),
            total("total_tips", "tip_amount"),
            mean("avg_fare", "total_amount"),
            mean("avg_distance", "trip_distance"),
        ],
        keys=["pickup_date"],
        order_by=["pickup_date"],
    )


def top_pickup_zones(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """All zones with trips, the busiest first."""
    return rollup(
        trips,
        [row_count("trip_count"), total("total_revenue", "total_amount")],
        dims=[Dim(zones, "pickup_location_id", "location_id", ["borough", "zone"])],
        order_by=[F.desc("trip_count"), "borough", "zone"],
    )


def payment_breakdown(trips: DataFrame, payments: DataFrame) -> DataFrame:
    return rollup(
        trips,
        [
            row_count("trip_count"),
            total("total_revenue", "total_amount"),
            mean("avg_tip", "tip_amount"),
        ],
        dims=[Dim(payments, "payment_type", "payment_type", ["payment_description"])],
        order_by=[F.desc("trip_count"), "payment_description"],
    )


def trips_by_borough(trips: DataFrame, zones: DataFrame) -> DataFrame:
    return rollup(
        trips,
        [row_count("trips")],
        dims=[Dim(zones, "pickup_location_id", "location_id", ["borough"])],
        order_by=[F.desc("trips"), "borough"],
    )


def fact_checks(payments: DataFrame, dates: DataFrame) -> list:
    return [
        non_empty(),
        no_nulls("date_key", "pickup_location_id"),
        non_negative("fare_amount", "total_amount"),
        references("payment_type", payments, "payment_type"),
        references("date_key", dates, "date_key"),
    ]


def zone_notes(zones: DataFrame) -> list:
    """Told, but no reason to refuse: marts over zones leave such trips out."""
    return [
        references("pickup_location_id", zones, "location_id"),
        references("dropoff_location_id", zones, "location_id"),
    ]


def _silver_rows(counts: DataFrame) -> DataFrame:
    return counts.select(
        F.lit("bronze_trips").alias("table_name"),
        "check_name",
        "column_name",
        "violations",
        (F.col("violations") == 0).alias("passed"),
    )


def silver_report(raw: DataFrame, columns=REFINED_COLUMNS, rules=RULES) -> DataFrame:
    """What the way to silver leaves out: values lost to casts by column, rows rejected by rule. One scan."""
    return _silver_rows(losses_and_rejects(raw, columns, rules))


def observed_silver_report(outcomes: Outcomes) -> DataFrame:
    """``silver_report`` of a table that has just been written."""
    return _silver_rows(outcomes.report())


# Column tests of the marts.
MART_CHECKS = {
    "daily_revenue": [
        no_nulls("pickup_date"),
        unique("pickup_date"),
        no_nulls("trip_count"),
        no_nulls("total_revenue"),
    ],
    "top_pickup_zones": [no_nulls("zone"), no_nulls("trip_count")],
    "payment_breakdown": [
        no_nulls("payment_description"),
        unique("payment_description"),
        no_nulls("trip_count"),
    ],
}
