"""Reading and decoding: topics, JSON, delimited text, trip files, documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbflow.functions.text import arrival_text, iso_millis, to_vector
from curbflow.operators.clean import default_coords, default_time, stamp_arrival
from curbflow.operators.cluster import assign_clusters
from curbflow.plans import common
from curbflow.schemas import ENRICHED_FIELDS, EVENT_MAPPING, MOVIE, TRIP_COLUMNS, TRIP_MESSAGE
from curbflow.session import scratch_path
from curbflow.sinks.archive import archive_points
from curbflow.sinks.index import apply_mapping
from curbflow.sinks.messages import json_record, write_topics
from curbflow.sources.files import load_documents, read_point_files, read_trips_csv
from curbflow.sources.tables import read_table, trips
from curbflow.sources.topics import (
    Topics,
    decode_delimited,
    decode_json,
    decode_tagged,
    decode_or_text,
    read_topics,
)
from curbflow.streaming.jobs import ENRICHED, enriched_messages, trip_messages

PROPS = T.StructType([T.StructField("k", T.LongType())])
SQL_MESSY = """messy AS (
  SELECT event_id, CASE WHEN event_id % 101 = 0 THEN 'not json' ELSE props END AS value,
    event_id % 101 = 0 AS bad, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)"""


def multi_topic_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of both topics, written to topic folders and read by one subscription."""
    folder = Topics("parquet", scratch_path(spark, "topics"))
    write_topics(trip_messages(trips(spark, sf_dir)), folder)
    messages = read_topics(spark, folder, ["users", "cars"])
    return decode_json(messages, TRIP_MESSAGE).select("topic", "key", "trip_id", "timestamp")


def json_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips to JSON messages and back."""
    messages = trip_messages(trips(spark, sf_dir)).select("topic", "value")
    return decode_json(messages, TRIP_MESSAGE)


def _messy(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.when(F.col("event_id") % 101 == 0, "not json").otherwise(F.col("props"))
    return read_table(spark, sf_dir, "events").select("event_id", value.alias("value"))


def json_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded messages and, beside them, the undecodable ones."""
    return decode_tagged(_messy(spark, sf_dir), PROPS).select("event_id", "status", "k", "value")


def json_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message, decoded or as its raw text."""
    return decode_or_text(_messy(spark, sf_dir), PROPS)


def enriched_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched text messages, published and read back, to fields."""
    points = common.points(spark, sf_dir).withColumn("timestamp", arrival_text("ts"))
    folder = Topics("parquet", scratch_path(spark, "enriched"))
    write_topics(enriched_messages(points, common.centres()), folder)
    messages = read_topics(spark, folder, [ENRICHED]).select("value")
    fields = decode_delimited(messages, ",", ENRICHED_FIELDS)
    return fields.select(
        F.col("cluster").cast("int").alias("cluster"),
        F.col("lat").cast("double").alias("lat"),
        F.col("lon").cast("double").alias("lon"),
        "time_stamp",
    )


def point_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points archived as ``[lat,lon]`` lines, read back and counted."""
    path = scratch_path(spark, "points")
    archive_points(trips(spark, sf_dir), path, "dropoff_latitude", "dropoff_longitude")
    return read_point_files(spark, path).groupBy("x", "y").agg(F.count("*").alias("n"))


def trips_csv_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip files of two layouts in one folder: other names, another order, other fields."""
    t = trips(spark, sf_dir)
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    old = t.filter("trip_id % 2 = 0").select(
        F.col("vendor_id").cast("string").alias("vendor_id"), stamp.alias("pickup_datetime"), "trip_distance", "pickup_latitude"
    )
    new = t.filter("trip_id % 2 = 1").select(
        "pickup_latitude", F.lit(0.5).alias("extra"), F.col("vendor_id").cast("string").alias("VendorID"), stamp.alias("tpep_pickup_datetime")
    )
    path = scratch_path(spark, "layouts")
    for frame in (old, new):
        frame.write.mode("append").options(header="true", emptyValue="").csv(path)
    read = read_trips_csv(spark, path)
    return read.select(
        "vendor_id", F.date_format("pickup_datetime", "yyyy-MM-dd HH:mm:ss").alias("pickup_datetime"), "trip_distance", "pickup_latitude", "surcharge"
    )


def trips_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip files with a header, rows with a field too many and rows of nothing but commas."""
    t = trips(spark, sf_dir)
    empty = F.col("trip_id") % 113 == 0
    given = {
        "vendor_id": F.col("vendor_id"),
        "pickup_datetime": F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
        "trip_distance": F.col("trip_distance"),
        "pickup_longitude": F.col("pickup_longitude"),
        "pickup_latitude": F.col("pickup_latitude"),
        "dropoff_longitude": F.col("dropoff_longitude"),
        "dropoff_latitude": F.col("dropoff_latitude"),
        "passenger_count": F.col("trip_id") % 6,
        "total_amount": F.when(F.col("trip_id") % 127 == 0, "8,extra").otherwise("8.5"),
    }
    columns = [
        F.when(~empty, given.get(c, F.lit(None)).cast("string")).alias(c) for c in TRIP_COLUMNS.names
    ]
    path = scratch_path(spark, "csv")
    # no quoting, so that the extra comma makes an extra field
    t.select(*columns).write.options(header="true", quote="\u0000", emptyValue="").csv(path)
    read = read_trips_csv(spark, path)
    return read.select(
        "vendor_id",
        F.date_format("pickup_datetime", "yyyy-MM-dd HH:mm:ss").alias("pickup_datetime"),
        "passenger_count",
        "trip_distance",
        "pickup_longitude",
        "pickup_latitude",
        "dropoff_longitude",
        "dropoff_latitude",
        "total_amount",
    )


def documents_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON-line documents under a declared mapping with arrays; some misname their year."""
    docs = read_table(spark, sf_dir, "documents")
    year = (F.col("doc_id") % 30 + 1990).cast("int")
    named = F.col("doc_id") % 5 != 0
    lines = docs.select(
        F.col("doc_id").alias("_id"),
        F.concat_ws(" ", "lang", "source").alias("title"),
        F.when(named, year).alias("release_year"),
        F.when(~named, year).alias("release"),
        F.array("lang", "source").alias("genre"),
        F.array("source").alias("actors"),
        F.col("text").alias("description"),
    )
    path = scratch_path(spark, "documents")
    lines.write.json(path)
    loaded = load_documents(spark, path, MOVIE)
    return loaded.select(
        F.col("_id").alias("id"),
        "title",
        "release_year",
        F.array_join("genre", "|").alias("genre"),
        F.size("actors").cast("bigint").alias("actors"),
        "description",
    )


def null_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing coordinates become 0, a missing time becomes the arrival time."""
    t = trips(spark, sf_dir)
    t = t.withColumn("timestamp", F.when(F.col("trip_id") % 83 != 0, arrival_text("ts")))
    t = default_coords(t, ["pickup_latitude", "pickup_longitude"])
    t = default_time(t, "timestamp", common.NOW)
    return t.select("trip_id", "pickup_latitude", "pickup_longitude", "timestamp")


def iso_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    quoted = F.concat(F.lit('"'), arrival_text("ts"), F.lit('"'))
    return trips(spark, sf_dir).select("trip_id", iso_millis(quoted).alias("iso"))


def stamped_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record gets the arrival time."""
    t = stamp_arrival(trips(spark, sf_dir).drop("ts"), now=common.NOW)
    return t.select("trip_id", "topic", "timestamp")


def json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole rows as JSON objects that keep their nulls."""
    t = trips(spark, sf_dir).select(
        "trip_id", "topic", F.when(F.col("trip_id") % 97 != 0, F.col("vendor_id")).alias("vendor_id")
    )
    return t.select("trip_id", json_record(["trip_id", "topic", "vendor_id"]).alias("value"))


def vector_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points as dense vectors, their components and size."""
    vectors = trips(spark, sf_dir).select(
        "trip_id", to_vector("pickup_latitude", "pickup_longitude").alias("v")
    )
    return vectors.filter("v IS NOT NULL").select(
        "trip_id",
        F.get("v", 0).alias("v0"),
        F.get("v", 1).alias("v1"),
        F.size("v").cast("bigint").alias("dim"),
    )


def typed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-text documents under the event mapping; values that do not fit become null."""
    a = assign_clusters(common.points(spark, sf_dir), common.centres())
    texts = a.select(
        F.when(F.col("trip_id") % 53 == 0, "none").otherwise(F.col("cluster").cast("string")).alias("cluster"),
        F.concat_ws(",", F.col("lat").cast("string"), F.col("lon").cast("string")).alias("location"),
        F.when(F.col("trip_id") % 59 == 0, "soon").otherwise(iso_millis(arrival_text("ts"))).alias("time_stamp"),
    )
    typed = apply_mapping(texts, EVENT_MAPPING)
    return typed.select(
        "cluster",
        F.col("location.lat").alias("lat"),
        F.col("location.lon").alias("lon"),
        arrival_text("time_stamp").alias("time_stamp"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        multi_topic_union,
        json_decode,
        json_quarantine,
        json_fallback,
        enriched_decode,
        point_text_roundtrip,
        trips_csv_scan,
        trips_csv_layouts,
        documents_load,
        null_defaults,
        iso_timestamps,
        stamped_records,
        json_records,
        vector_points,
        typed_documents,
    )
}

ORACLES = {
    "multi_topic_union": f"""WITH {common.SQL_TRIPS}
SELECT topic, CAST(trip_id AS VARCHAR) AS key, trip_id, {common.SQL_ARRIVAL} AS timestamp FROM trips""",
    "json_decode": f"""WITH {common.SQL_TRIPS}
SELECT topic, trip_id, CAST(vendor_id AS DOUBLE) AS VendorID, pickup_latitude, pickup_longitude,
  dropoff_latitude, dropoff_longitude, trip_distance, {common.SQL_ARRIVAL} AS timestamp FROM trips""",
    "json_quarantine": f"""WITH {SQL_MESSY}
SELECT event_id, CASE WHEN bad THEN 'bad' ELSE 'good' END AS status,
  CASE WHEN NOT bad THEN k END AS k, CASE WHEN bad THEN value END AS value FROM messy""",
    "json_fallback": f"""WITH {SQL_MESSY}
SELECT event_id, CASE WHEN NOT bad THEN k END AS k, CASE WHEN bad THEN value END AS raw_text FROM messy""",
    "enriched_decode": f"""WITH {common.SQL_ASSIGNED}
SELECT CAST(cluster AS INTEGER) AS cluster, lat, lon, {common.SQL_ISO} AS time_stamp
FROM assigned WHERE topic = 'users'""",
    "point_text_roundtrip": f"""WITH {common.SQL_TRIPS}
SELECT dropoff_latitude AS x, dropoff_longitude AS y, count(*) AS n FROM trips GROUP BY ALL""",
    "trips_csv_layouts": f"""WITH {common.SQL_TRIPS}
SELECT CAST(vendor_id AS VARCHAR) AS vendor_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS pickup_datetime,
  CASE WHEN trip_id % 2 = 0 THEN trip_distance END AS trip_distance, pickup_latitude,
  CASE WHEN trip_id % 2 = 1 THEN 0.5e0 END AS surcharge FROM trips""",
    "trips_csv_scan": f"""WITH {common.SQL_TRIPS},
kept AS (SELECT *, trip_id % 113 <> 0 AS given FROM trips WHERE trip_id % 127 <> 0 OR trip_id % 113 = 0)
SELECT CASE WHEN given THEN CAST(vendor_id AS VARCHAR) END AS vendor_id,
  CASE WHEN given THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS pickup_datetime,
  CASE WHEN given THEN CAST(trip_id % 6 AS INTEGER) END AS passenger_count,
  CASE WHEN given THEN trip_distance END AS trip_distance,
  CASE WHEN given THEN pickup_longitude END AS pickup_longitude,
  CASE WHEN given THEN pickup_latitude END AS pickup_latitude,
  CASE WHEN given THEN dropoff_longitude END AS dropoff_longitude,
  CASE WHEN given THEN dropoff_latitude END AS dropoff_latitude,
  CASE WHEN given THEN 8.5e0 END AS total_amount
FROM kept""",
    "documents_load": """SELECT CAST(doc_id AS INTEGER) AS id, lang || ' ' || source AS title,
  CASE WHEN doc_id % 5 <> 0 THEN CAST(doc_id % 30 + 1990 AS INTEGER) END AS release_year,
  lang || '|' || source AS genre, CAST(1 AS BIGINT) AS actors, text AS description FROM documents""",
    "null_defaults": f"""WITH {common.SQL_TRIPS}
SELECT trip_id, coalesce(pickup_latitude, 0) AS pickup_latitude,
  coalesce(pickup_longitude, 0) AS pickup_longitude,
  CASE WHEN trip_id % 83 <> 0 THEN {common.SQL_ARRIVAL} ELSE '2024-01-31 00:00:00.000' END AS timestamp
FROM trips""",
    "iso_timestamps": f"WITH {common.SQL_TRIPS} SELECT trip_id, {common.SQL_ISO} AS iso FROM trips",
    "stamped_records": f"""WITH {common.SQL_TRIPS}
SELECT trip_id, topic, '2024-01-31 00:00:00.000' AS timestamp FROM trips""",
    "json_records": f"""WITH {common.SQL_TRIPS}
SELECT trip_id, '{{"trip_id":' || trip_id || ',"topic":"' || topic || '","vendor_id":' ||
  CASE WHEN trip_id % 97 <> 0 THEN CAST(vendor_id AS VARCHAR) ELSE 'null' END || '}}' AS value FROM trips""",
    "vector_points": f"""WITH {common.SQL_TRIPS}
SELECT trip_id, pickup_latitude AS v0, pickup_longitude AS v1, CAST(2 AS BIGINT) AS dim FROM trips
WHERE pickup_latitude IS NOT NULL AND pickup_longitude IS NOT NULL""",
    "typed_documents": f"""WITH {common.SQL_ASSIGNED}
SELECT CASE WHEN trip_id % 53 <> 0 THEN CAST(cluster AS INTEGER) END AS cluster, lat, lon,
  CASE WHEN trip_id % 59 <> 0 THEN {common.SQL_ARRIVAL} END AS time_stamp FROM assigned""",
}
