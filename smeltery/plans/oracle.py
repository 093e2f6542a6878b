"""The same results in plain SQL for DuckDB, written independently of the Spark side."""

_RAW = """
raw AS (
  SELECT l_suppkey AS vendor_id, o_orderdate AS pickup_at, l_shipdate AS dropoff_at,
         l_linenumber - 1 AS passenger_count, l_quantity AS trip_distance,
         c_nationkey AS pickup_location_id, s_nationkey AS dropoff_location_id,
         CAST(left(o_orderpriority, 1) AS INTEGER) AS payment_type,
         l_extendedprice AS fare_amount,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(18,2)) AS DOUBLE)
           AS tip_amount,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(1 + l_tax AS DECIMAL(18,2)) AS DOUBLE)
           AS total_amount
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey
)"""

_TRIPS = (
    _RAW
    + """,
trips AS (
  SELECT *, CAST(pickup_at AS DATE) AS pickup_date,
         (CAST(floor(epoch(dropoff_at)) AS BIGINT) - CAST(floor(epoch(pickup_at)) AS BIGINT)) / 60.0
           AS trip_duration_minutes
  FROM raw
  WHERE pickup_at IS NOT NULL AND dropoff_at IS NOT NULL AND pickup_at < dropoff_at
    AND trip_distance > 0 AND fare_amount >= 0 AND total_amount >= 0 AND passenger_count > 0
)"""
)

_FACT = (
    _TRIPS
    + """,
fact AS (
  SELECT CAST(strftime(pickup_date, '%Y%m%d') AS INTEGER) AS date_key, pickup_date,
         pickup_location_id, dropoff_location_id, payment_type, passenger_count, trip_distance,
         trip_duration_minutes, fare_amount, tip_amount, total_amount
  FROM trips
)"""
)

_DIMS = """,
dim_zone AS (
  SELECT n_nationkey AS location_id, r_name AS borough, n_name AS zone,
         'zone ' || n_nationkey AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
dim_payment AS (
  SELECT * FROM (VALUES (1, 'Credit card'), (2, 'Cash'), (3, 'No charge'), (4, 'Dispute'),
                        (5, 'Unknown'), (6, 'Voided trip')) AS v(payment_type, payment_description)
)"""


def _units(x: str) -> str:
    """Exact sum in ten-thousandths."""
    return f"CAST(sum(CAST({x} AS DECIMAL(18,4))) * 10000 AS HUGEINT)"


def _total(x: str) -> str:
    return f"CAST(CAST(sum(CAST({x} AS DECIMAL(18,4))) AS DECIMAL(38,2)) AS DOUBLE)"


def _mean(x: str) -> str:
    return (
        f"CAST((2 * {_units(x)} + 100 * count({x})) // (200 * count({x})) AS BIGINT) / 100.0"
    )


_DAILY = f"""
SELECT pickup_date, count(*) AS trip_count, {_total('total_amount')} AS total_revenue,
       {_total('tip_amount')} AS total_tips, {_mean('total_amount')} AS avg_fare,
       {_mean('trip_distance')} AS avg_distance
FROM trips GROUP BY pickup_date"""

_ZONES = f"""
SELECT borough, zone, count(*) AS trip_count, {_total('total_amount')} AS total_revenue
FROM trips JOIN dim_zone ON pickup_location_id = location_id GROUP BY borough, zone"""

_PAYMENTS = f"""
SELECT payment_description, count(*) AS trip_count, {_total('total_amount')} AS total_revenue,
       {_mean('tip_amount')} AS avg_tip
FROM trips JOIN dim_payment USING (payment_type) GROUP BY payment_description"""

_ONE_PER_KEY = """row_number() OVER (
  PARTITION BY vendor_id, pickup_at, dropoff_at, pickup_location_id, dropoff_location_id
  ORDER BY passenger_count, trip_distance, payment_type, fare_amount, tip_amount, total_amount) = 1"""

_CLEAN_COLUMNS = """vendor_id, pickup_at, dropoff_at, passenger_count, trip_distance,
       pickup_location_id, dropoff_location_id, payment_type, fare_amount, tip_amount, total_amount"""


def _check(table: str, check: str, column: str, violations: str, source: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{check}' AS check_name, '{column}' AS column_name, "
        f"CAST(v AS BIGINT) AS violations, v = 0 AS passed FROM (SELECT {violations} AS v FROM {source})"
    )


def _union(*parts: str) -> str:
    return "\nUNION ALL\n".join(parts)


_EMPTY = "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END"


def _nulls(*columns: str) -> str:
    return f"count(*) FILTER (WHERE {' OR '.join(c + ' IS NULL' for c in columns)})"


def _repeats(source: str, columns: str) -> str:
    return f"(SELECT {columns} FROM {source} GROUP BY {columns} HAVING count(*) > 1)"


_DIM_DATE = """
SELECT DISTINCT CAST(strftime(pickup_date, '%Y%m%d') AS INTEGER) AS date_key,
       pickup_date AS calendar_date, CAST(year(pickup_date) AS INTEGER) AS year,
       CAST(month(pickup_date) AS INTEGER) AS month, CAST(day(pickup_date) AS INTEGER) AS day,
       CAST(dayofweek(pickup_date) + 1 AS INTEGER) AS day_of_week
FROM trips WHERE pickup_date IS NOT NULL"""

_FEW_ORPHANS = "fact WHERE payment_type IS NULL OR payment_type NOT IN (1, 2, 3)"

_NULL_LINES = """null_lines AS (
  SELECT nullif(l_linenumber, 3) AS l_linenumber, nullif(l_returnflag, 'R') AS l_returnflag
  FROM lineitem
)"""

_MONTHLY = """
SELECT o_orderkey, o_custkey % 7 AS passengers, o_totalprice, o_orderdate FROM orders"""

_RULES = {
    "pickup_known": "pickup_at IS NOT NULL",
    "dropoff_known": "dropoff_at IS NOT NULL",
    "pickup_before_dropoff": "pickup_at < dropoff_at",
    "distance_positive": "trip_distance > 0",
    "fare_not_negative": "fare_amount >= 0",
    "total_not_negative": "total_amount >= 0",
    "passengers_positive": "passenger_count > 0",
}

_LOSSES = {
    "o_custkey": "TRY_CAST(o_custkey AS TINYINT)",
    "o_totalprice": "CASE WHEN abs(o_totalprice) < 32768 THEN 1 END",
    "o_orderpriority": "TRY_CAST(o_orderpriority AS INTEGER)",
    "o_orderkey": "o_orderkey",
}

_REFINED = {
    "vendor_id": "BIGINT",
    "pickup_at": "TIMESTAMP",
    "dropoff_at": "TIMESTAMP",
    "passenger_count": "INTEGER",
    "trip_distance": "DOUBLE",
    "pickup_location_id": "INTEGER",
    "dropoff_location_id": "INTEGER",
    "payment_type": "INTEGER",
    "fare_amount": "DOUBLE",
    "tip_amount": "DOUBLE",
    "total_amount": "DOUBLE",
}

SQL = {
    "normalize": f"WITH {_RAW} SELECT {_CLEAN_COLUMNS} FROM raw",
    "conform_union": _MONTHLY,
    "cast_losses": _union(
        *[
            f"SELECT '{name}' AS column_name, "
            f"count(*) FILTER (WHERE {name} IS NOT NULL AND ({cast}) IS NULL) AS lost_values FROM orders"
            for name, cast in _LOSSES.items()
        ]
    ),
    "clean_trips": f"""WITH {_TRIPS}
SELECT {_CLEAN_COLUMNS}, pickup_date, trip_duration_minutes FROM trips QUALIFY {_ONE_PER_KEY}""",
    "rule_rejects": f"WITH {_RAW}\n"
    + _union(
        *[
            f"SELECT '{name}' AS rule_name, count(*) FILTER (WHERE NOT coalesce({rule}, false)) "
            f"AS rejected_rows, count(*) AS total_rows FROM raw"
            for name, rule in _RULES.items()
        ]
    ),
    "silver_report": f"WITH {_RAW}\n"
    + _union(
        *[
            f"SELECT 'bronze_trips' AS table_name, 'cast_loss' AS check_name, '{name}' AS column_name, "
            f"CAST(count(*) FILTER (WHERE {name} IS NOT NULL AND TRY_CAST({name} AS {kind}) IS NULL) AS BIGINT) "
            f"AS violations, count(*) FILTER (WHERE {name} IS NOT NULL AND TRY_CAST({name} AS {kind}) IS NULL) = 0 "
            f"AS passed FROM raw"
            for name, kind in _REFINED.items()
        ],
        *[_check("bronze_trips", "rule_reject", name,
                 f"count(*) FILTER (WHERE NOT coalesce({rule}, false))", "raw") for name, rule in _RULES.items()],
    ),
    "enrich_duration": """
SELECT user_id, CAST(first_at AS DATE) AS event_date, first_at, last_at,
       (CAST(floor(epoch(last_at)) AS BIGINT) - CAST(floor(epoch(first_at)) AS BIGINT)) / 60.0
         AS span_minutes
FROM (SELECT user_id, CAST(ts AS DATE) AS day, min(ts) AS first_at, max(ts) AS last_at
      FROM events GROUP BY ALL)
WHERE first_at < last_at""",
    "dedup_by_key": """
SELECT * FROM lineitem QUALIFY row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax,
           l_returnflag, l_linestatus) = 1""",
    "dim_date": f"WITH {_TRIPS} {_DIM_DATE}",
    "dim_zone": f"WITH one AS (SELECT 1){_DIMS} SELECT * FROM dim_zone",
    "fact_table": f"WITH {_FACT} SELECT * FROM fact",
    "table_count": f"WITH {_FACT} SELECT count(*) AS trip_count FROM fact",
    "daily_revenue": f"WITH {_TRIPS} {_DAILY} ORDER BY pickup_date",
    "top_pickup_zones": f"WITH {_TRIPS}{_DIMS} {_ZONES} ORDER BY trip_count DESC, borough, zone",
    "payment_breakdown": f"WITH {_TRIPS}{_DIMS} {_PAYMENTS} ORDER BY trip_count DESC, payment_description",
    "trips_by_borough": f"""WITH {_TRIPS}{_DIMS}
SELECT borough, count(*) AS trips FROM trips JOIN dim_zone ON pickup_location_id = location_id
GROUP BY borough ORDER BY trips DESC, borough""",
    "trips_between_boroughs": f"""WITH {_TRIPS}{_DIMS}
SELECT p.borough AS pickup_borough, d.borough AS dropoff_borough, count(*) AS trips,
       {_total('total_amount')} AS total_revenue
FROM trips JOIN dim_zone p ON pickup_location_id = p.location_id
JOIN dim_zone d ON dropoff_location_id = d.location_id GROUP BY 1, 2""",
    "uneven_amounts": """
SELECT event_type, count(*) AS n,
       CAST(round(sum(CAST(value / 3 AS DECIMAL(28,16))), 2) AS DOUBLE) AS total_third,
       CAST(round(sum(CAST(value / 3 AS DECIMAL(28,16))) / count(value), 3) AS DOUBLE) AS mean_third
FROM events GROUP BY event_type""",
    "sql_model": f"""WITH {_TRIPS}{_DIMS}
SELECT borough, count(*) AS trip_count, {_total('total_amount')} AS total_revenue
FROM trips JOIN dim_zone ON pickup_location_id = location_id GROUP BY borough""",
    "dq_non_empty": _union(
        _check("customer", "non_empty", "", _EMPTY, "customer"),
        _check("rich_customer", "non_empty", "", _EMPTY, "customer WHERE c_acctbal > 1e12"),
    ),
    "dq_no_nulls": f"WITH {_NULL_LINES}\n"
    + _union(
        _check("lineitem", "no_nulls", "l_linenumber, l_returnflag",
               _nulls("l_linenumber", "l_returnflag"), "null_lines"),
        _check("lineitem", "no_nulls", "l_linenumber", _nulls("l_linenumber"), "null_lines"),
        _check("lineitem", "no_nulls", "l_returnflag", _nulls("l_returnflag"), "null_lines"),
    ),
    "dq_non_negative": _union(
        _check("customer", "non_negative", "c_acctbal", "count(*)", "customer WHERE c_acctbal < 0"),
        _check("customer", "non_negative", "c_nationkey", "count(*)", "customer WHERE c_nationkey < 0"),
    ),
    "dq_referential_integrity": f"WITH {_FACT}\n"
    + _check("fact_trips", "references", "payment_type", "count(*)", _FEW_ORPHANS),
    "dq_orphan_keys": f"""WITH {_NULL_LINES}
SELECT l_linenumber, count(*) AS orphan_rows FROM null_lines
WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_size <= 4 AND p_size = l_linenumber)
GROUP BY l_linenumber""",
    "dq_unique": """
SELECT l_orderkey, l_linenumber, count(*) AS key_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "dq_report": f"WITH {_FACT}{_DIMS}, dim_date AS ({_DIM_DATE})\n"
    + _union(
        _check("fact_trips", "non_empty", "", _EMPTY, "fact"),
        _check("fact_trips", "no_nulls", "date_key, pickup_location_id",
               _nulls("date_key", "pickup_location_id"), "fact"),
        _check("fact_trips", "non_negative", "fare_amount", "count(*)", "fact WHERE fare_amount < 0"),
        _check("fact_trips", "non_negative", "total_amount", "count(*)", "fact WHERE total_amount < 0"),
        _check("fact_trips", "references", "payment_type", "count(*)", _FEW_ORPHANS),
        _check("fact_trips", "references", "date_key", "count(*)",
               "fact ANTI JOIN dim_date USING (date_key)"),
        _check("dim_zone", "non_empty", "", _EMPTY, "dim_zone"),
        _check("dim_zone", "unique", "borough, zone", "count(*)", _repeats("dim_zone", "borough, zone")),
        _check("dim_zone", "unique", "borough", "count(*)", _repeats("dim_zone", "borough")),
        _check("customer", "non_negative", "c_acctbal", "count(*)", "customer WHERE c_acctbal < 0"),
    ),
    "mart_tests": f"WITH {_TRIPS}{_DIMS}, daily AS ({_DAILY}), zones AS ({_ZONES}), "
    f"payments AS ({_PAYMENTS})\n"
    + _union(
        _check("daily_revenue", "no_nulls", "pickup_date", _nulls("pickup_date"), "daily"),
        _check("daily_revenue", "unique", "pickup_date", "count(*)", _repeats("daily", "pickup_date")),
        _check("daily_revenue", "no_nulls", "trip_count", _nulls("trip_count"), "daily"),
        _check("daily_revenue", "no_nulls", "total_revenue", _nulls("total_revenue"), "daily"),
        _check("top_pickup_zones", "no_nulls", "zone", _nulls("zone"), "zones"),
        _check("top_pickup_zones", "no_nulls", "trip_count", _nulls("trip_count"), "zones"),
        _check("payment_breakdown", "no_nulls", "payment_description",
               _nulls("payment_description"), "payments"),
        _check("payment_breakdown", "unique", "payment_description", "count(*)",
               _repeats("payments", "payment_description")),
        _check("payment_breakdown", "no_nulls", "trip_count", _nulls("trip_count"), "payments"),
    ),
    "csv_dim_roundtrip": f"WITH one AS (SELECT 1){_DIMS} SELECT * FROM dim_zone",
    "publish_roundtrip": f"WITH {_FACT} SELECT * FROM fact",
    "partitioned_publish": f"""WITH {_FACT} SELECT * FROM fact
WHERE (pickup_date NOT BETWEEN DATE '1996-01-01' AND DATE '1996-01-31' OR trip_distance <= 25
       OR pickup_date NOT IN (SELECT pickup_date FROM fact WHERE trip_distance <= 25))""",
    "incremental_ingest": _MONTHLY,
    "snapshot_log": f"""WITH {_FACT}
SELECT 'fact_trips' AS table_name, 1 AS version, count(*) AS row_count FROM fact
WHERE pickup_date < DATE '1998-01-01'
UNION ALL SELECT 'fact_trips', 2, count(*) FROM fact""",
    "view_after_publish": f"WITH {_FACT} SELECT *, CAST(payment_type AS VARCHAR) AS paid FROM fact",
    "read_old_version": f"WITH {_FACT} SELECT * FROM fact WHERE pickup_date < DATE '1998-01-01'",
    # The layers de-duplicate: sf0.001 and sf0.1 each hold one repeated trip key.
    "layered_daily_revenue": f"WITH {_TRIPS.replace('trips AS', 'valid AS')}, "
    f"trips AS (SELECT * FROM valid QUALIFY {_ONE_PER_KEY}) {_DAILY}",
}
