"""Continuous training without per-batch callbacks.

Three steps, each restartable from what it has already written:

1. ``land_points`` streams points into a table partitioned by time.
2. ``train_closed_windows`` folds the model over the windows that are complete and newer than
   the last trained one, and appends the models it made.
3. ``publish_trained`` writes the event documents, enriched messages and typed cluster documents
   of the windows that have a model but no documents; ``publish_closed_windows`` writes flat
   demand/supply documents alone.

A window is trained before it is assigned. A replayed step finds its windows done, so none is
learned from twice. Points that arrive after their window was trained stay in the landed
table and do not change the model.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from curbflow.functions.text import arrival_text, iso_millis
from curbflow.operators.clean import timestamp_literal, to_event_document
from curbflow.operators.cluster import (
    POINT_COLUMNS,
    Centres,
    assign_with_history,
    history_df,
    train_windows,
    window_range,
)
from curbflow.operators.metrics import supply_demand, to_cluster_document, with_centres
from curbflow.schemas import CLUSTER_MAPPING, ENRICHED_FIELDS, EVENT_MAPPING, Field
from curbflow.session import reliable_checkpoint
from curbflow.sinks.index import _path_exists, apply_mapping
from curbflow.sinks.messages import delimited
from curbflow.sinks.streams import DEFAULT_INTERVAL, start

# Partition texts of the landed table. They sort as the times do.
GRAINS = {"hour": ("yyyy-MM-dd-HH", "%Y-%m-%d-%H"), "day": ("yyyy-MM-dd", "%Y-%m-%d")}

# After this many windows the new models are written, so a lost driver repeats at most as many.
SAVE_EVERY = 100

LANDED_SCHEMA = "topic STRING, lat DOUBLE, lon DOUBLE, ts TIMESTAMP, part STRING"


def land_points(
    points: DataFrame,
    path: str,
    checkpoint: str,
    grain: str = "hour",
    interval: str | None = DEFAULT_INTERVAL,
) -> StreamingQuery:
    """Appends points to the landed table, each exactly once.

    The grain is the reading unit of the training: hours for windows of seconds or minutes,
    days for longer ones.
    """
    part = F.date_format("ts", GRAINS[grain][0]).alias("part")
    return start(points.select("topic", "lat", "lon", "ts", part), "parquet", checkpoint, path, interval, ["part"])


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LANDED_SCHEMA).parquet(path)


def _parts(grain: str, first: datetime, end: datetime | None = None) -> Column:
    """The partitions that can hold points from ``first`` up to ``end``."""
    part, form = F.col("part"), GRAINS[grain][1]
    after = part >= first.strftime(form)
    return after if end is None else after & (part <= end.strftime(form))


def latest_model(spark: SparkSession, models: str, k: int) -> tuple[datetime, Centres] | None:
    """The newest window in the model table and its model; k rows reach the driver."""
    if not _path_exists(spark, models):
        return None
    rows = spark.read.parquet(models).orderBy(F.desc("batch"), "cluster").limit(k).collect()
    return (rows[0]["batch"], Centres.from_rows(rows)) if rows else None


def train_closed_windows(
    spark: SparkSession,
    landed: str,
    models: str,
    initial: Centres,
    every: timedelta,
    decay: float,
    delay: timedelta = timedelta(0),
    unit: str = "batches",
    grain: str = "hour",
) -> list[tuple[datetime, Centres]]:
    """Trains on every window that ended ``delay`` or longer before the newest point."""
    known = latest_model(spark, models, initial.k)
    points = read_landed(spark, landed)
    fresh = points
    centres = initial
    if known:
        last, centres = known
        since = timestamp_literal(points, "ts", last + every)
        fresh = points.filter(_parts(grain, last + every) & (F.col("ts") >= since))
    # all points move the clock, as they move a watermark; only users teach the model
    newest = fresh.agg(F.max("ts").cast("timestamp_ntz").alias("t")).first()["t"]
    bounds = window_range(fresh, "ts", every)
    if bounds is None:
        return []
    first = known[0] + every if known else bounds[0]
    last_closed = bounds[1]
    while last_closed + every > newest - delay:
        last_closed -= every
    users = points.filter(F.col("topic") == "users")
    trained, unsaved = [], []
    for step in train_windows(
        users,
        centres,
        every,
        decay,
        unit,
        bounds=(first, last_closed),
        prune=lambda begin, end: _parts(grain, begin, end),
    ):
        trained.append(step)
        unsaved.append(step)
        if len(unsaved) == SAVE_EVERY:
            _save(spark, unsaved, models)
            unsaved = []
    _save(spark, unsaved, models)
    return trained


def _save(spark: SparkSession, steps: list[tuple[datetime, Centres]], models: str) -> None:
    if steps:
        history_df(spark, steps).coalesce(1).write.mode("append").parquet(models)


def publish_closed_windows(
    spark: SparkSession, landed: str, models: str, index: str, k: int, every: timedelta, grain: str = "hour"
) -> None:
    """Appends the documents of the windows that have a model but no documents yet."""
    history = _unpublished(spark, models, index)
    assigned = _assigned_points(spark, landed, history, k, every, grain)
    if assigned is None:
        return
    documents = with_centres(
        supply_demand(assigned, ["batch"]),
        history.select("batch", "cluster", *POINT_COLUMNS),
        ["batch", "cluster"],
    )
    documents.write.mode("append").parquet(index)


def publish_trained(
    spark: SparkSession, landed: str, models: str, out: str, k: int, every: timedelta, grain: str = "hour"
) -> None:
    """All outputs of the windows that have a model but no cluster documents yet, from one
    assignment by the models that learned them:

    ``out/events`` typed event documents of both topics, ``out/enriched`` text messages of the
    user points keyed by cluster, ``out/clusters`` typed cluster documents. Each output has a
    folder per window, which a repeated step replaces as a whole, and the cluster documents, which
    mark a window as done, come last.
    """
    clusters = f"{out}/clusters"
    history = _unpublished(spark, models, clusters)
    assigned = _assigned_points(spark, landed, history, k, every, grain)
    if assigned is None:
        return
    assigned = reliable_checkpoint(spark, assigned.withColumn("time_stamp", iso_millis(arrival_text("ts"))))
    rest = [Field("topic", "string"), Field("batch", "timestamp_ntz")]
    _replace(apply_mapping(to_event_document(assigned, keep=["topic", "batch"]), [*EVENT_MAPPING, *rest]), f"{out}/events")
    users = assigned.filter("topic = 'users'")
    messages = users.select(
        F.col("cluster").cast("string").alias("key"), delimited(ENRICHED_FIELDS).alias("value"), F.lit("usersenriched").alias("topic"), "batch"
    )
    _replace(messages, f"{out}/enriched")
    placed = with_centres(
        supply_demand(assigned, ["batch"]), history.select("batch", "cluster", *POINT_COLUMNS), ["batch", "cluster"]
    )
    documents = apply_mapping(to_cluster_document(placed, ["batch"]), [Field("batch", "timestamp_ntz"), *CLUSTER_MAPPING])
    _replace(documents, clusters)


def _replace(df: DataFrame, path: str) -> None:
    """Writes whole windows; a window that was written before is replaced."""
    stamped = df.withColumn("batch", F.date_format("batch", "yyyy-MM-dd'T'HH-mm-ss"))
    writer = stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("batch").parquet(path)


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """One output of ``publish_trained``, with ``batch`` as a timestamp again."""
    stored = spark.read.option("spark.sql.sources.partitionColumnTypeInference.enabled", "false").parquet(path)
    return stored.withColumn("batch", F.to_timestamp_ntz(F.col("batch").cast("string"), F.lit("yyyy-MM-dd'T'HH-mm-ss")))


def _unpublished(spark: SparkSession, models: str, index: str) -> DataFrame:
    """The models of the windows after the last one in the index."""
    history = spark.read.parquet(models)
    if _path_exists(spark, index):
        stored = read_published(spark, index) if index.endswith("/clusters") else spark.read.parquet(index)
        done = stored.agg(F.max("batch")).first()[0]
        if done is not None:
            history = history.filter(F.col("batch") > timestamp_literal(history, "batch", done))
    return history


def _assigned_points(
    spark: SparkSession, landed: str, history: DataFrame, k: int, every: timedelta, grain: str
) -> DataFrame | None:
    """The landed points of the windows in ``history``, each with its window's cluster."""
    edges = history.agg(F.min("batch").alias("a"), F.max("batch").alias("b")).first()
    if edges["a"] is None:
        return None
    points = read_landed(spark, landed)
    begin, end = edges["a"], edges["b"] + every
    inside = (
        _parts(grain, begin, end)
        & (F.col("ts") >= timestamp_literal(points, "ts", begin))
        & (F.col("ts") < timestamp_literal(points, "ts", end))
    )
    return assign_with_history(points.filter(inside), history, k, every)
