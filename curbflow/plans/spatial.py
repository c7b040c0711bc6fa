"""Points, boxes, distances and geohashes."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.functions import geo
from curbflow.operators import clean
from curbflow.plans import common
from curbflow.session import scratch_path
from curbflow.sinks.point_index import append_points, read_box, read_near
from curbflow.sources.tables import read_table, register_views, trips

# The searched centre, radius and box corners.
CENTRE = (40.74861, -73.98441)
RADIUS_M = 10 * geo.MILE_M
TOP_LEFT = (40.8, -74.0)
BOTTOM_RIGHT = (40.7, -73.0)


def demand_supply_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.to_points(trips(spark, sf_dir)).select("trip_id", "topic", "lat", "lon")


def _boxed(spark: SparkSession, sf_dir: str, box: geo.Box, place: str) -> DataFrame:
    kept = clean.in_box(trips(spark, sf_dir), f"{place}_latitude", f"{place}_longitude", box)
    return kept.select("trip_id", f"{place}_latitude", f"{place}_longitude")


def box_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dropoffs in box A."""
    return _boxed(spark, sf_dir, geo.BOX_A, "dropoff")


def box_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dropoffs in box B."""
    return _boxed(spark, sf_dir, geo.BOX_B, "dropoff")


def box_c(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pickups in box C."""
    return _boxed(spark, sf_dir, geo.BOX_C, "pickup")


def null_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = clean.drop_null_points(trips(spark, sf_dir), ["ts", "pickup_longitude", "pickup_latitude"])
    return kept.select("trip_id", "pickup_latitude", "pickup_longitude")


def non_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_table(spark, sf_dir, "events")
    tagged = events.select(
        "event_id", F.when(F.col("user_id") % 7 == 0, "").otherwise(F.col("event_type")).alias("tag")
    )
    return clean.non_empty(tagged, "tag")


def within_10_miles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pickups within ten miles of the centre, with their distance."""
    near = clean.within_distance(
        trips(spark, sf_dir), "pickup_latitude", "pickup_longitude", CENTRE, RADIUS_M
    )
    metres = geo.haversine_m("pickup_latitude", "pickup_longitude", CENTRE)
    return near.select("trip_id", F.round(metres, 3).alias("metres"))


def geo_bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = clean.geo_bounding_box(
        trips(spark, sf_dir), "dropoff_latitude", "dropoff_longitude", TOP_LEFT, BOTTOM_RIGHT
    )
    return kept.select("trip_id", "dropoff_latitude", "dropoff_longitude")


def geohash8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips(spark, sf_dir).select(
        "trip_id",
        geo.geohash("pickup_latitude", "pickup_longitude", 8).alias("pick_location"),
        geo.geohash("dropoff_latitude", "dropoff_longitude", 8).alias("drop_location"),
    )


def trip_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Geohash documents with 0 for missing coordinates."""
    t = trips(spark, sf_dir).withColumn("timestamp", clean.arrival_text("ts"))
    filled = clean.default_coords(t, ["pickup_latitude", "pickup_longitude", "trip_distance"])
    return clean.to_trip_document(filled)


def geo_point_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dropoffs written in the four encodings in turn and parsed back."""
    t = trips(spark, sf_dir)
    lat, lon = F.col("dropoff_latitude").cast("string"), F.col("dropoff_longitude").cast("string")
    form = F.col("trip_id") % 4
    text = (
        F.when(form == 0, F.concat(lat, F.lit(", "), lon))
        .when(form == 1, F.concat(F.lit('{"lat": '), lat, F.lit(', "lon": '), lon, F.lit("}")))
        .when(form == 2, F.concat(F.lit("["), lon, F.lit(", "), lat, F.lit("]")))
        .otherwise(geo.geohash("dropoff_latitude", "dropoff_longitude", 12))
    )
    texts = t.select("trip_id", text.alias("location"))
    parsed = texts.select("trip_id", geo.parse_geo_point("location").alias("p"))
    return parsed.select("trip_id", F.round("p.lat", 5).alias("lat"), F.round("p.lon", 5).alias("lon"))


def _stored(spark: SparkSession, sf_dir: str, place: str) -> tuple[str, tuple[str, str]]:
    """All trips stored by one of their places, a commit for each topic."""
    path, columns = scratch_path(spark, "points"), (f"{place}_latitude", f"{place}_longitude")
    every = trips(spark, sf_dir).select("trip_id", "topic", *columns)
    for i, topic in enumerate(("users", "cars")):
        append_points(spark, path, every.filter(F.col("topic") == topic), *columns, batch=("load", i))
    return path, columns


def indexed_geo_bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The box search on stored points, from the files near the box."""
    path, columns = _stored(spark, sf_dir, "dropoff")
    return read_box(spark, path, TOP_LEFT, BOTTOM_RIGHT, *columns).select("trip_id", *columns)


def indexed_within_10_miles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distance search on stored points, with the distance."""
    path, columns = _stored(spark, sf_dir, "pickup")
    near = read_near(spark, path, CENTRE, RADIUS_M, *columns)
    return near.select("trip_id", F.round(geo.haversine_m(*columns, CENTRE), 3).alias("metres"))


def sql_view_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL over a registered view."""
    register_views(spark, sf_dir, ["events"])
    return spark.sql(
        """SELECT topic, count(*) AS n, count(pickup_latitude) AS with_latitude,
             round(avg(dropoff_latitude), 6) AS mean_latitude
           FROM trips WHERE dropoff_longitude < -73 GROUP BY topic"""
    )


QUERIES = {
    f.__name__: f
    for f in (
        demand_supply_points,
        box_a,
        box_b,
        box_c,
        null_drop,
        non_empty,
        within_10_miles,
        geo_bbox,
        indexed_geo_bbox,
        indexed_within_10_miles,
        geohash8,
        trip_documents,
        geo_point_forms,
        sql_view_points,
    )
}


def sql_geohash(lat: str, lon: str, precision: int) -> str:
    """The geohash as SQL text over the binary digits of both axes."""
    lat_bits, lon_bits = 5 * precision // 2, (5 * precision + 1) // 2
    lat_text = f"lpad(bin(CAST(floor(({lat} + 90) / 180 * {1 << lat_bits}) AS BIGINT)), {lat_bits}, '0')"
    lon_text = f"lpad(bin(CAST(floor(({lon} + 180) / 360 * {1 << lon_bits}) AS BIGINT)), {lon_bits}, '0')"
    letters = []
    for letter in range(precision):
        digits = []
        for j in range(5):
            place, on_lat = divmod(5 * letter + j, 2)
            text = lat_text if on_lat else lon_text
            digits.append(f"CAST(substr({text}, {place + 1}, 1) AS INTEGER) * {1 << (4 - j)}")
        letters.append(f"substr('{geo.GEOHASH_ALPHABET}', 1 + {' + '.join(digits)}, 1)")
    return f"CASE WHEN {lat} IS NOT NULL AND {lon} IS NOT NULL THEN {' || '.join(letters)} END"


def _sql_box(place: str, condition: str) -> str:
    lat, lon = f"{place}_latitude", f"{place}_longitude"
    return f"""WITH {common.SQL_TRIPS} SELECT trip_id, {lat}, {lon} FROM trips
WHERE {condition.format(lat=lat, lon=lon)}"""


def sql_haversine(lat: str, lon: str) -> str:
    lat0, lon0 = (math.radians(c) for c in CENTRE)
    h = (
        f"pow(sin((radians({lat}) - {lat0!r}) / 2), 2)"
        f" + cos(radians({lat})) * {math.cos(lat0)!r} * pow(sin((radians({lon}) - ({lon0!r})) / 2), 2)"
    )
    return f"{2 * geo.EARTH_RADIUS_M!r} * asin(sqrt({h}))"


_METRES = sql_haversine("pickup_latitude", "pickup_longitude")

ORACLES = {
    "demand_supply_points": f"WITH {common.SQL_ALL_POINTS} SELECT trip_id, topic, lat, lon FROM all_points",
    "box_a": _sql_box("dropoff", "{lat} > 39 AND {lat} < 41 AND {lon} > -75 AND {lon} < -73"),
    "box_b": _sql_box("dropoff", "{lat} > 40 AND {lat} < 42 AND {lon} > -75 AND {lon} < -73"),
    "box_c": _sql_box("pickup", "{lat} > 40 AND {lat} < 41 AND {lon} > -74 AND {lon} < -73"),
    "null_drop": _sql_box("pickup", "ts IS NOT NULL AND {lat} IS NOT NULL AND {lon} IS NOT NULL"),
    "non_empty": "SELECT event_id, event_type AS tag FROM events WHERE user_id % 7 <> 0",
    "within_10_miles": f"""WITH {common.SQL_TRIPS}, d AS (SELECT trip_id, {_METRES} AS metres FROM trips)
SELECT trip_id, round(metres, 3) AS metres FROM d WHERE metres <= {RADIUS_M!r}""",
    "geo_bbox": _sql_box("dropoff", "{lat} BETWEEN 40.7 AND 40.8 AND {lon} BETWEEN -74.0 AND -73.0"),
    "geohash8": f"""WITH {common.SQL_TRIPS}
SELECT trip_id, {sql_geohash('pickup_latitude', 'pickup_longitude', 8)} AS pick_location,
  {sql_geohash('dropoff_latitude', 'dropoff_longitude', 8)} AS drop_location FROM trips""",
    "trip_documents": f"""WITH {common.SQL_TRIPS}, filled AS (
  SELECT ts, trip_distance, dropoff_latitude, dropoff_longitude,
    coalesce(pickup_latitude, 0) AS plat, coalesce(pickup_longitude, 0) AS plon FROM trips)
SELECT {sql_geohash('plat', 'plon', 8)} AS pick_location,
  {sql_geohash('dropoff_latitude', 'dropoff_longitude', 8)} AS drop_location,
  {common.SQL_ARRIVAL} AS time_stamp, trip_distance FROM filled""",
    "geo_point_forms": f"""WITH {common.SQL_TRIPS}
SELECT trip_id, round(dropoff_latitude, 5) AS lat, round(dropoff_longitude, 5) AS lon FROM trips""",
    "sql_view_points": f"""WITH {common.SQL_TRIPS}
SELECT topic, count(*) AS n, count(pickup_latitude) AS with_latitude,
  round(avg(dropoff_latitude), 6) AS mean_latitude
FROM trips WHERE dropoff_longitude < -73 GROUP BY topic""",
}
ORACLES["indexed_geo_bbox"] = ORACLES["geo_bbox"]
ORACLES["indexed_within_10_miles"] = ORACLES["within_10_miles"]
