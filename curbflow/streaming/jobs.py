"""The streaming topology.

messages -> points -> (enriched topic, event index, demand/supply index)
enriched topic -> typed index
messages -> box filter -> republished topic
messages -> trip index, point archive

Each function maps a stream (or a batch) to the rows of one sink; the ``start_`` functions of
the sinks run it. Every sink is its own query with its own checkpoint, so one can restart
without the others.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbflow.functions.geo import BOX_C, Box, has_numbers
from curbflow.functions.text import arrival_text, iso_millis
from curbflow.operators.clean import (
    default_coords,
    default_time,
    drop_null_points,
    in_box,
    to_event_document,
    to_points,
    to_trip_document,
)
from curbflow.operators.cluster import Centres, assign_clusters
from curbflow.operators.metrics import windowed_supply_demand, with_centres
from curbflow.schemas import (
    ENRICHED_FIELDS,
    EVENT_MAPPING,
    REPUBLISHED_FIELDS,
    SPACE_MILLIS,
    TRIP_MESSAGE,
)
from curbflow.sinks.index import apply_mapping
from curbflow.sinks.messages import delimited, json_record, to_messages
from curbflow.sources.topics import decode_delimited, decode_lenient

# Topic names.
USERS = "users"
CARS = "cars"
ENRICHED = "usersenriched"


def trip_messages(trips: DataFrame) -> DataFrame:
    """Trips as JSON messages of their topic, stamped with their time."""
    message = trips.select(
        "topic",
        "trip_id",
        F.col("vendor_id").cast("double").alias("VendorID"),
        "pickup_latitude",
        "pickup_longitude",
        "dropoff_latitude",
        "dropoff_longitude",
        "trip_distance",
        arrival_text("ts").alias("timestamp"),
    )
    fields = [c for c in message.columns if c != "topic"]
    return to_messages(message, F.col("topic"), json_record(fields), key=F.col("trip_id"))


def decoded_trips(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(trips, undecodable messages)."""
    tagged = decode_lenient(messages.select("topic", "value"), TRIP_MESSAGE, {"VendorID": ("vendor_id",)})
    good, bad = tagged.filter("status = 'good'").drop("status", "value"), tagged.filter("status = 'bad'")
    ts = F.try_to_timestamp("timestamp", F.lit(SPACE_MILLIS))
    return good.withColumns({"vendor_id": F.col("VendorID"), "ts": ts}), bad.select("topic", "value")


def quarantined_messages(messages: DataFrame) -> DataFrame:
    """What the point jobs leave out, for a sink of its own: messages that are no JSON object, and
    points without a finite place or a readable time, each with the reason."""
    trips, bad = decoded_trips(messages)
    points = to_points(trips)
    whole = has_numbers(["lat", "lon"])
    reason = F.when(~F.coalesce(whole, F.lit(False)), "place").when(F.col("ts").isNull(), "time")
    lost = points.withColumn("reason", reason).filter("reason IS NOT NULL")
    fields = [f.name for f in TRIP_MESSAGE.fields]
    return bad.select("topic", "value", F.lit("json").alias("reason")).union(
        lost.select("topic", json_record(fields).alias("value"), "reason")
    )


def trip_points(messages: DataFrame) -> DataFrame:
    """Demand and supply points of the decodable messages that have a finite place and a readable time."""
    trips, _ = decoded_trips(messages)
    return to_points(trips).filter(has_numbers(["lat", "lon"]) & F.col("ts").isNotNull())


def enriched_messages(points: DataFrame, centres: Centres) -> DataFrame:
    """User points with their cluster, as text messages keyed by cluster."""
    users = assign_clusters(points.filter(F.col("topic") == USERS), centres)
    users = users.withColumn("time_stamp", iso_millis("timestamp"))
    return to_messages(users, ENRICHED, delimited(ENRICHED_FIELDS), key=F.col("cluster"))


def event_documents(points: DataFrame, centres: Centres, topic: str) -> DataFrame:
    """Typed event documents of one topic."""
    assigned = assign_clusters(points.filter(F.col("topic") == topic), centres)
    documents = to_event_document(assigned.withColumn("time_stamp", iso_millis("timestamp")))
    return apply_mapping(documents, EVENT_MAPPING)


def supply_demand_documents(
    points: DataFrame, centres: Centres, length: str = "5 seconds", delay: str = "10 seconds"
) -> DataFrame:
    """Users, cars, ratio and place of each cluster and window.

    One grouped state per window and cluster, at most k rows each; a window is emitted when
    the watermark passes its end.
    """
    marked = assign_clusters(points, centres).withWatermark("ts", delay)
    return with_centres(windowed_supply_demand(marked, length), centres)


def enriched_documents(messages: DataFrame) -> DataFrame:
    """Typed documents from the enriched topic."""
    fields = decode_delimited(messages.select("value"), ",", ENRICHED_FIELDS)
    return apply_mapping(to_event_document(fields), EVENT_MAPPING)


def republished_messages(messages: DataFrame, topic: str = CARS, box: Box = BOX_C) -> DataFrame:
    """Messages with a pickup inside the box, as JSON of text fields, to one topic."""
    trips, _ = decoded_trips(messages)
    complete = drop_null_points(trips, ["timestamp", "pickup_longitude", "pickup_latitude"])
    kept = in_box(complete, "pickup_latitude", "pickup_longitude", box)
    texts = kept.select(*[F.col(c).cast("string").alias(c) for c in REPUBLISHED_FIELDS])
    return to_messages(texts, topic, json_record(REPUBLISHED_FIELDS))


def trip_documents(messages: DataFrame, now: datetime | None = None) -> DataFrame:
    """Geohash documents of the decodable messages, with 0 for missing numbers."""
    trips, _ = decoded_trips(messages)
    numbers = [
        "pickup_latitude",
        "pickup_longitude",
        "dropoff_latitude",
        "dropoff_longitude",
        "trip_distance",
    ]
    filled = default_time(default_coords(trips, numbers), "timestamp", now)
    return to_trip_document(filled)
