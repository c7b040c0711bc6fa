"""Assignment, demand/supply metrics and map grids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.functions.geo import BOX_C, precision_for_zoom
from curbflow.operators import metrics as m
from curbflow.operators import tiles
from curbflow.operators.clean import in_box, last_days, to_points
from curbflow.operators.cluster import assign_clusters
from curbflow.plans import common
from curbflow.plans.spatial import sql_geohash
from curbflow.session import scratch_path
from curbflow.sinks.tiles import add_rows, read_tiles
from curbflow.sources.tables import trips

# The zoom level at which the map panels open.
PANEL_ZOOM = 13
PRECISION = precision_for_zoom(PANEL_ZOOM)
DAY = "1 day"


def _batch(df: DataFrame) -> DataFrame:
    """Adds ``batch``, the day as text."""
    return df.withColumn("batch", F.date_format("ts", "yyyy-MM-dd"))


def assigned_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return common.assigned(spark, sf_dir).select("trip_id", "topic", "lat", "lon", "cluster")


def _placed_ratio(points: DataFrame) -> DataFrame:
    ratios = m.supply_demand(assign_clusters(points, common.centres()))
    placed = m.with_centres(ratios, common.centres())
    return placed.select("cluster", "u_count", "c_count", F.round("ratio", 6).alias("ratio"), "lat", "lon")


def supply_demand_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users, cars, their ratio and the place of each cluster, over all points."""
    return _placed_ratio(to_points(trips(spark, sf_dir)))


def supply_demand_boxed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for points in box C, which leaves missing coordinates out as well."""
    return _placed_ratio(in_box(to_points(trips(spark, sf_dir)), "lat", "lon", BOX_C))


def cluster_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster documents of each daily batch."""
    ratios = m.supply_demand(_batch(common.assigned(spark, sf_dir)), ["batch"])
    placed = m.with_centres(ratios, common.centres())
    documents = placed.select("batch", "cluster", "ratio", "u_count", "c_count", F.struct("lat", "lon").alias("location"))
    return documents.select(
        "batch",
        "cluster",
        F.round("ratio", 6).alias("ratio"),
        "u_count",
        "c_count",
        F.col("location.lat").alias("lat"),
        F.col("location.lon").alias("lon"),
    )


def supply_demand_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demand and supply per value bucket of a batch, one-sided clusters included."""
    hourly = common.assigned(spark, sf_dir).withColumn("batch", F.date_format("ts", "yyyy-MM-dd HH"))
    ratios = m.supply_demand(hourly, ["batch"], how="outer")
    return ratios.select("batch", "cluster", "u_count", "c_count", F.round("ratio", 6).alias("ratio"))


def cluster_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.cluster_counts(_batch(common.assigned(spark, sf_dir)), ["batch"])


def tumbling_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per day, topic and cluster."""
    counts = m.tumbling_counts(common.assigned(spark, sf_dir), DAY, by=["topic", "cluster"])
    return counts.select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "topic", "cluster", "n"
    )


def vendor_pair_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of the per-batch join on the vendor key."""
    return m.vendor_pair_counts(_batch(common.assigned(spark, sf_dir)), ["batch"])


def vendor_pair_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ratio that follows from those sizes."""
    pairs = m.vendor_pair_counts(_batch(common.assigned(spark, sf_dir)), ["batch"])
    sides = pairs.groupBy("batch", "cluster").agg(
        F.sum(F.when(F.col("topic") == "users", F.col("pairs"))).alias("u_count"),
        F.sum(F.when(F.col("topic") == "cars", F.col("pairs"))).alias("c_count"),
    )
    ratio = F.round(F.col("u_count").cast("double") / F.col("c_count"), 6).alias("ratio")
    return sides.filter("u_count IS NOT NULL AND c_count IS NOT NULL").select(
        "batch", "cluster", "u_count", "c_count", ratio
    )


def grid_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents panel: last seven days, documents per map cell."""
    recent = last_days(common.points(spark, sf_dir), "ts", 7, common.NOW)
    return m.geohash_grid(recent, [F.count("*").alias("n")], PRECISION)


def grid_avg_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ratio panel: mean ratio of the daily cluster documents per map cell."""
    ratios = m.supply_demand(_batch(common.assigned(spark, sf_dir)), ["batch"])
    placed = m.with_centres(ratios, common.centres())
    return m.geohash_grid(placed, [F.round(F.avg("ratio"), 6).alias("avg_ratio")], PRECISION)


def tile_pyramid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and their distance per map cell at precisions 1 to 7, from a stored pyramid: all
    points come in, cars at their pickup; then those are taken away and come in at their dropoff."""
    path = scratch_path(spark, "tiles")
    every = to_points(trips(spark, sf_dir)).select("trip_id", "topic", "lat", "lon", "trip_distance")
    pickups = trips(spark, sf_dir).select("trip_id", "topic", F.col("pickup_latitude").alias("lat"), F.col("pickup_longitude").alias("lon"), "trip_distance")
    cars = F.col("topic") == "cars"
    add_rows(spark, path, pickups, ["trip_distance"], batch=("load", 0))
    moved = pickups.filter(cars).withColumn("sign", F.lit(-1)).unionByName(every.filter(cars).withColumn("sign", F.lit(1)))
    add_rows(spark, path, moved, ["trip_distance"], sign=F.col("sign"), batch=("load", 1))
    cells = tiles.with_geohash(read_tiles(spark, path))
    return cells.select("precision", "geohash", "n", F.round("sum_trip_distance", 4).alias("distance"))


def cluster_value_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.value_frequency(common.assigned(spark, sf_dir), "trip_distance")


QUERIES = {
    f.__name__: f
    for f in (
        assigned_points,
        supply_demand_ratio,
        supply_demand_boxed,
        cluster_documents,
        supply_demand_outer,
        cluster_counts,
        tumbling_counts,
        vendor_pair_counts,
        vendor_pair_ratio,
        grid_count,
        grid_avg_ratio,
        cluster_value_freq,
        tile_pyramid,
    )
}

_DAY_TEXT = "strftime(ts, '%Y-%m-%d')"
_BY_TOPIC = "count(*) FILTER (topic = 'users') AS u_count, count(*) FILTER (topic = 'cars') AS c_count"
_DAILY = f"""daily AS (SELECT {_DAY_TEXT} AS batch, CAST(cluster AS INTEGER) AS cluster, {_BY_TOPIC}
  FROM assigned GROUP BY ALL)"""
# The join as stated, counted by pairing grouped sides.
_PAIRS = f"""keyed AS (SELECT {_DAY_TEXT} AS batch, topic, count(*) AS keyed_points FROM assigned
  WHERE vendor_id = 1 GROUP BY ALL),
predicted AS (SELECT {_DAY_TEXT} AS batch, topic, CAST(cluster AS INTEGER) AS cluster,
  count(*) AS predictions FROM assigned GROUP BY ALL),
pairs AS (SELECT batch, topic, cluster, keyed_points, predictions, keyed_points * predictions AS pairs
  FROM keyed JOIN predicted USING (batch, topic))"""



def _sql_ratio(where: str) -> str:
    return f"""WITH {common.SQL_ASSIGNED}, counted AS (
  SELECT cluster, {_BY_TOPIC} FROM assigned WHERE {where} GROUP BY cluster)
SELECT CAST(c.cluster AS INTEGER) AS cluster, u_count, c_count,
  round(CAST(u_count AS DOUBLE) / c_count, 6) AS ratio, clat AS lat, clon AS lon
FROM counted c JOIN centres USING (cluster) WHERE u_count > 0 AND c_count > 0"""

_LEVELS = " UNION ALL ".join(
    f"SELECT {p} AS precision, {sql_geohash('lat', 'lon', p)} AS geohash, trip_distance FROM points" for p in range(1, 8)
)

ORACLES = {
    "tile_pyramid": f"""WITH {common.SQL_POINTS}, levels AS ({_LEVELS})
SELECT precision, geohash, count(*) AS n, round(sum(trip_distance), 4) AS distance FROM levels GROUP BY ALL""",
    "assigned_points": f"""WITH {common.SQL_ASSIGNED}
SELECT trip_id, topic, lat, lon, CAST(cluster AS INTEGER) AS cluster FROM assigned""",
    "supply_demand_ratio": _sql_ratio("TRUE"),
    "supply_demand_boxed": _sql_ratio("lat > 40 AND lat < 41 AND lon > -74 AND lon < -73"),
    "cluster_documents": f"""WITH {common.SQL_ASSIGNED}, {_DAILY}
SELECT batch, d.cluster, round(CAST(u_count AS DOUBLE) / c_count, 6) AS ratio, u_count, c_count,
  clat AS lat, clon AS lon
FROM daily d JOIN centres USING (cluster) WHERE u_count > 0 AND c_count > 0""",
    "supply_demand_outer": f"""WITH {common.SQL_ASSIGNED}
SELECT strftime(ts, '%Y-%m-%d %H') AS batch, CAST(cluster AS INTEGER) AS cluster, {_BY_TOPIC},
  CASE WHEN count(*) FILTER (topic = 'cars') > 0 THEN round(CAST(count(*) FILTER (topic = 'users') AS DOUBLE)
    / count(*) FILTER (topic = 'cars'), 6) END AS ratio
FROM assigned GROUP BY ALL""",
    "cluster_counts": f"""WITH {common.SQL_ASSIGNED}
SELECT {_DAY_TEXT} AS batch, topic, CAST(cluster AS INTEGER) AS cluster, count(*) AS n
FROM assigned GROUP BY ALL""",
    "tumbling_counts": f"""WITH {common.SQL_ASSIGNED}
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS window_start, topic,
  CAST(cluster AS INTEGER) AS cluster, count(*) AS n FROM assigned GROUP BY ALL""",
    "vendor_pair_counts": f"""WITH {common.SQL_ASSIGNED}, {_PAIRS} SELECT * FROM pairs""",
    "vendor_pair_ratio": f"""WITH {common.SQL_ASSIGNED}, {_PAIRS}
SELECT u.batch, u.cluster, u.pairs AS u_count, c.pairs AS c_count,
  round(CAST(u.pairs AS DOUBLE) / c.pairs, 6) AS ratio
FROM pairs u JOIN pairs c ON u.batch = c.batch AND u.cluster = c.cluster
WHERE u.topic = 'users' AND c.topic = 'cars'""",
    "grid_count": f"""WITH {common.SQL_POINTS}
SELECT {sql_geohash('lat', 'lon', PRECISION)} AS geohash, count(*) AS n FROM points
WHERE ts >= {common.SQL_NOW} - INTERVAL 7 DAY AND ts <= {common.SQL_NOW} GROUP BY 1""",
    "grid_avg_ratio": f"""WITH {common.SQL_ASSIGNED}, {_DAILY}
SELECT {sql_geohash('clat', 'clon', PRECISION)} AS geohash,
  round(avg(CAST(u_count AS DOUBLE) / c_count), 6) AS avg_ratio
FROM daily JOIN centres USING (cluster) WHERE u_count > 0 AND c_count > 0 GROUP BY 1""",
    "cluster_value_freq": f"""WITH {common.SQL_ASSIGNED}
SELECT CAST(cluster AS INTEGER) AS cluster, trip_distance, count(*) AS n FROM assigned GROUP BY ALL""",
}
