"""Small raw trips in the published column layout."""

from datetime import datetime

from smeltery.plans.trips import RAW_COLUMNS

SCHEMA = ", ".join(f"{n} {t}" for n, t in RAW_COLUMNS)
EXTRAS = 4.75  # what a trip costs beyond its fare


def at(hour, minute=0, second=0, day=17, month=9):
    return datetime(2021, month, day, hour, minute, second)


def trip(pickup, dropoff, distance=6.4, fare=21.25, **changes):
    row = dict.fromkeys(name for name, _ in RAW_COLUMNS)
    row |= {"VendorID": 5, "passenger_count": 2, "PULocationID": 41, "DOLocationID": 74, "payment_type": 2}
    row |= {"tpep_pickup_datetime": pickup, "tpep_dropoff_datetime": dropoff, "trip_distance": distance}
    row |= {"fare_amount": fare, "tip_amount": 3.5, "total_amount": None if fare is None else fare + EXTRAS}
    return tuple({**row, **changes}.values())


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)
