"""Demand and supply counts, ratios and map grids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from curbflow.functions.geo import geohash_cell, geohash_text, has_numbers
from curbflow.operators.cluster import Centres


def cluster_counts(assigned: DataFrame, by: list[str] = ()) -> DataFrame:
    """Events per cluster and topic, and per batch when ``by`` names one.

    Points without a cluster are left out by counting the clusters: a filter on the cluster
    would be copied below the assignment and compute it twice.
    """
    keys = [*by, "topic", "cluster"]
    return assigned.groupBy(*keys).agg(F.count("cluster").alias("n")).filter("n > 0")


def supply_demand(
    assigned: DataFrame, by: list[str | Column] = (), how: str = "inner"
) -> DataFrame:
    """``u_count``, ``c_count`` and ``ratio`` = users / cars per cluster.

    Both counts come from one grouped pass, which equals joining two counted frames on the
    cluster but shuffles once. ``inner`` keeps clusters that have both; ``outer`` keeps all,
    with a null ratio where there is no car.
    """
    if how not in ("inner", "outer"):
        raise ValueError("how is 'inner' or 'outer'")
    counts = (
        assigned.groupBy(*by, "cluster")
        .agg(
            F.count(F.when(F.col("topic") == "users", F.col("cluster"))).alias("u_count"),
            F.count(F.when(F.col("topic") == "cars", F.col("cluster"))).alias("c_count"),
        )
    )
    keep = (F.col("u_count") > 0) & (F.col("c_count") > 0)
    if how == "outer":
        keep = (F.col("u_count") > 0) | (F.col("c_count") > 0)
    ratio = F.when(F.col("c_count") > 0, F.col("u_count").cast("double") / F.col("c_count"))
    return counts.filter(keep).withColumn("ratio", ratio)


def with_centres(ratios: DataFrame, centres: Centres | DataFrame, on: list[str] = ("cluster",)) -> DataFrame:
    """Adds the place of each cluster.

    A model's rows come from the driver with their true size, so Spark broadcasts them while that
    is small; a table of models is joined as Spark sees fit.
    """
    if isinstance(centres, Centres):
        centres = centres.to_df(ratios.sparkSession)
    return ratios.join(centres.drop("weight"), list(on))


def to_cluster_document(placed: DataFrame, keep: list[str] = ()) -> DataFrame:
    """``{cluster, ratio, u_count, c_count, location: {lat, lon}}``, and the columns to keep."""
    location = F.struct("lat", "lon").alias("location")
    return placed.select("cluster", "ratio", "u_count", "c_count", location, *keep)


def vendor_pair_counts(
    assigned: DataFrame, by: list[str] = (), vendor: str = "vendor_id", key: float = 1.0
) -> DataFrame:
    """Row counts of the join of ``(vendor, point)`` with ``(key, cluster)`` per batch and topic.

    That join pairs every point of the vendor with every prediction of the batch. The pairs
    are quadratic and never made: a cluster has (points of the vendor) x (points of the
    cluster) of them, and both factors come from one grouped pass.
    """
    by_cluster = (
        assigned.groupBy(*by, "topic", "cluster")
        .agg(
            F.count("cluster").alias("predictions"),
            F.count(F.when(F.col(vendor) == key, F.col("cluster"))).alias("_keyed"),
        )
        .filter("predictions > 0")
    )
    # k rows per batch and topic from here on, so the window is small
    side = W.partitionBy(*by, "topic")
    paired = by_cluster.withColumn("keyed_points", F.sum("_keyed").over(side))
    pairs = (F.col("keyed_points") * F.col("predictions")).alias("pairs")
    return paired.filter("keyed_points > 0").select(*by, "topic", "cluster", "keyed_points", "predictions", pairs)


def geohash_grid(
    df: DataFrame, aggregates: list[Column], precision: int, lat: str = "lat", lon: str = "lon"
) -> DataFrame:
    """Aggregates per geohash cell.

    Rows are grouped on the two cell integers; the text of a cell is made once per cell, not
    once per row.
    """
    row, column = geohash_cell(lat, lon, precision)
    cells = (
        df.filter(has_numbers([lat, lon]))
        .groupBy(row.alias("_row"), column.alias("_column"))
        .agg(*aggregates)
        .filter(F.col("_row").isNotNull())
    )
    values = [c for c in cells.columns if c not in ("_row", "_column")]
    return cells.select(geohash_text("_row", "_column", precision).alias("geohash"), *values)


def value_frequency(assigned: DataFrame, value: str, cluster: str = "cluster") -> DataFrame:
    """How often each value occurs in each cluster."""
    return assigned.groupBy(cluster, value).agg(F.count("*").alias("n"))


def tumbling_window(ts: str, length: str) -> Column:
    """Start of the event-time window, for use as a grouping key named ``batch``."""
    return F.window(ts, length).alias("_window")


def tumbling_counts(df: DataFrame, length: str, ts: str = "ts", by: list[str] = ("topic",)) -> DataFrame:
    """Rows per tumbling window and key; on a stream give ``df`` a watermark first."""
    counted = df.groupBy(tumbling_window(ts, length), *by).agg(F.count("*").alias("n"))
    start, end = (F.col(f"_window.{edge}").cast("timestamp_ntz").alias(f"window_{edge}") for edge in ("start", "end"))
    return counted.select(start, end, *by, "n")


def windowed_supply_demand(assigned: DataFrame, length: str, ts: str = "ts") -> DataFrame:
    """``supply_demand`` per tumbling window; on a stream give it a watermark first."""
    ratios = supply_demand(assigned, [tumbling_window(ts, length)])
    start = F.col("_window.start").cast("timestamp_ntz").alias("window_start")
    return ratios.select(start, "cluster", "u_count", "c_count", "ratio")
