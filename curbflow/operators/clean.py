"""Cleaning, defaults, points and filters over whole frames."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbflow.functions import geo
from curbflow.functions.text import arrival_text


def timestamp_literal(df: DataFrame, column: str, moment: datetime) -> Column:
    """A literal of the column's own type, so that comparing it can reach the scan."""
    literal = _wall_clock(moment)
    is_wall_clock = isinstance(df.schema[column].dataType, T.TimestampNTZType)
    return literal if is_wall_clock else literal.cast("timestamp")


def _wall_clock(moment: datetime) -> Column:
    """A literal that reads the same in every session time zone."""
    return F.expr(f"TIMESTAMP_NTZ '{moment:%Y-%m-%d %H:%M:%S.%f}'")


def to_points(trips: DataFrame) -> DataFrame:
    """Demand and supply points: users stand where they were picked up, cars where they
    dropped off. Adds ``lat`` and ``lon``."""
    demand = F.col("topic") == "users"
    return trips.withColumns(
        {
            "lat": F.when(demand, F.col("pickup_latitude")).otherwise(F.col("dropoff_latitude")),
            "lon": F.when(demand, F.col("pickup_longitude")).otherwise(F.col("dropoff_longitude")),
        }
    )


def default_coords(df: DataFrame, columns: list[str]) -> DataFrame:
    """Missing numbers become 0. Zero points show up at geohash ``s000...``, so this is
    for callers who ask for it."""
    return df.na.fill(0, subset=columns)


def default_time(df: DataFrame, column: str, now: datetime | None = None) -> DataFrame:
    """A missing time text becomes the arrival time."""
    moment = F.current_timestamp() if now is None else _wall_clock(now)
    return df.withColumn(column, F.coalesce(column, arrival_text(moment)))


def stamp_arrival(df: DataFrame, column: str = "timestamp", now: datetime | None = None) -> DataFrame:
    """Every row gets the arrival time as text."""
    moment = F.current_timestamp() if now is None else _wall_clock(now)
    return df.withColumn(column, arrival_text(moment))


def drop_null_points(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drops rows with a null, or a number that is none, in any of the columns."""
    floating = (T.DoubleType, T.FloatType)
    numbers = [c for c in columns if isinstance(df.schema[c].dataType, floating)]
    kept = [F.col(c).isNotNull() for c in columns if c not in numbers]
    kept += [geo.has_numbers([c]) for c in numbers]
    return df.filter(reduce(lambda a, b: a & b, kept))


def non_empty(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column) != "")


def in_box(df: DataFrame, lat: str, lon: str, box: geo.Box) -> DataFrame:
    """Rows strictly inside the box."""
    return df.filter(geo.in_box(lat, lon, box))


def within_distance(
    df: DataFrame, lat: str, lon: str, centre: tuple[float, float], metres: float
) -> DataFrame:
    return df.filter(geo.within_distance(lat, lon, centre, metres))


def geo_bounding_box(
    df: DataFrame, lat: str, lon: str, top_left: tuple[float, float], bottom_right: tuple[float, float]
) -> DataFrame:
    """Rows inside the box or on its edge."""
    return df.filter(geo.in_bounding_box(lat, lon, top_left, bottom_right))


def where_expr(df: DataFrame, text: str) -> DataFrame:
    """Rows for which a SQL expression holds."""
    return df.filter(F.expr(text))


def last_days(df: DataFrame, ts: str, days: int, now: datetime | None = None) -> DataFrame:
    """Rows of the last ``days`` days."""
    if now is None:
        return df.filter(F.col(ts) >= F.current_timestamp() - F.expr(f"INTERVAL {int(days)} DAYS"))
    start = timestamp_literal(df, ts, now) - F.expr(f"INTERVAL {int(days)} DAYS")
    return df.filter((F.col(ts) >= start) & (F.col(ts) <= timestamp_literal(df, ts, now)))


def to_event_document(assigned: DataFrame, time_stamp: str = "time_stamp", keep: list[str] = ()) -> DataFrame:
    """``{cluster, location: {lat, lon}, time_stamp}``, and the columns to keep."""
    location = F.struct(F.col("lat"), F.col("lon")).alias("location")
    return assigned.select("cluster", location, F.col(time_stamp).alias("time_stamp"), *keep)


def to_trip_document(trips: DataFrame, precision: int = 8) -> DataFrame:
    """``{pick_location, drop_location, time_stamp, trip_distance}`` with geohash locations."""
    return trips.select(
        geo.geohash("pickup_latitude", "pickup_longitude", precision).alias("pick_location"),
        geo.geohash("dropoff_latitude", "dropoff_longitude", precision).alias("drop_location"),
        F.col("timestamp").alias("time_stamp"),
        F.col("trip_distance").cast("double").alias("trip_distance"),
    )
