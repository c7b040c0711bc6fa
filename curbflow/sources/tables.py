"""The driver tables and the trip view over ``events``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The view text is valid in both engines, so queries and oracles see the same trips.
TRIP_VIEW_COLUMNS = [
    "event_id AS trip_id",
    "ts",
    "1 + user_id % 2 AS vendor_id",
    "CASE WHEN event_type IN ('signup','view','click') THEN 'users' ELSE 'cars' END AS topic",
    "CASE WHEN event_id % 97 = 0 THEN NULL"
    " ELSE 39.5e0 + ((event_id*7919) % 20000)/10000.0e0 END AS pickup_latitude",
    "CASE WHEN event_id % 89 = 0 THEN NULL"
    " ELSE -74.5e0 + ((event_id*10427 + user_id*31) % 20000)/10000.0e0 END AS pickup_longitude",
    "39.5e0 + ((event_id*5003 + user_id*17) % 20000)/10000.0e0 AS dropoff_latitude",
    "-74.5e0 + ((event_id*3001 + user_id*13) % 20000)/10000.0e0 AS dropoff_longitude",
    "value AS trip_distance",
]
TRIP_VIEW_SQL = f"SELECT {', '.join(TRIP_VIEW_COLUMNS)} FROM events"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table as a file stream."""
    schema = read_table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_trips(read_table(spark, sf_dir, "events"))


def as_trips(events: DataFrame) -> DataFrame:
    """Trips with pickup and dropoff points, derived row by row from events."""
    return events.selectExpr(*TRIP_VIEW_COLUMNS)


def register_views(spark: SparkSession, sf_dir: str, names: list[str]) -> None:
    """Temporary views for SQL: the given tables, and ``trips`` when events is among them."""
    for name in names:
        read_table(spark, sf_dir, name).createOrReplaceTempView(name)
    if "events" in names:
        trips(spark, sf_dir).createOrReplaceTempView("trips")
