"""Inputs and SQL fragments that several queries share."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from curbflow.operators.clean import drop_null_points, to_points
from curbflow.operators.cluster import Centres, assign_clusters, given_centres
from curbflow.sources.tables import TRIP_VIEW_SQL, trips

# Four well-separated centres for the checked queries.
CENTRE_COORDS = [(40.0, -74.0), (41.0, -74.0), (40.0, -73.0), (41.0, -73.0)]
NOW = datetime(2024, 1, 31)
SQL_NOW = "TIMESTAMP '2024-01-31 00:00:00'"


def centres(weight: float = 0.0) -> Centres:
    return given_centres(CENTRE_COORDS, weight)


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demand and supply points with both coordinates."""
    return drop_null_points(to_points(trips(spark, sf_dir)), ["lat", "lon"])


def assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_clusters(points(spark, sf_dir), centres())


# SQL side. Each fragment is a list of WITH entries.
SQL_TRIPS = f"trips AS ({TRIP_VIEW_SQL})"
SQL_ALL_POINTS = (
    SQL_TRIPS
    + """, all_points AS (
  SELECT *, CASE WHEN topic = 'users' THEN pickup_latitude ELSE dropoff_latitude END AS lat,
    CASE WHEN topic = 'users' THEN pickup_longitude ELSE dropoff_longitude END AS lon
  FROM trips)"""
)
SQL_POINTS = (
    SQL_ALL_POINTS
    + ", points AS (SELECT * FROM all_points WHERE lat IS NOT NULL AND lon IS NOT NULL)"
)


def sql_centres(coords=None) -> str:
    rows = ", ".join(f"({i}, {lat}e0, {lon}e0)" for i, (lat, lon) in enumerate(coords or CENTRE_COORDS))
    return f"centres(cluster, clat, clon) AS (VALUES {rows})"


def sql_assign(points: str, centres: str, out: str, on: str = "TRUE", id: str = "trip_id") -> str:
    """``out``: each row of ``points`` with the nearest row of ``centres``."""
    return f"""{out} AS (
  SELECT p.*, c.cluster FROM {points} p JOIN {centres} c ON {on}
  QUALIFY row_number() OVER (PARTITION BY p.{id}
    ORDER BY (p.lat - c.clat) * (p.lat - c.clat) + (p.lon - c.clon) * (p.lon - c.clon), c.cluster) = 1)"""


SQL_ASSIGNED = f"{SQL_POINTS}, {sql_centres()}, {sql_assign('points', 'centres', 'assigned')}"

SQL_ISO = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%g')"
SQL_ARRIVAL = "strftime(ts, '%Y-%m-%d %H:%M:%S.%g')"
