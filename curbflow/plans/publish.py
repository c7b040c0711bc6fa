"""Publishing and indexing: message payloads, routing, ids, upserts, index counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.functions.text import arrival_text, doc_type, iso_text
from curbflow.operators.clean import to_event_document
from curbflow.operators.routing import route_topic, with_doc_id
from curbflow.plans import common
from curbflow.session import scratch_path
from curbflow.sinks.index import (
    append_index,
    counts_by,
    index_counts as count_indices,
    latest_by_id,
    merge_into_index,
    upsert_index,
)
from curbflow.sinks.messages import delimited, to_messages, write_topics
from curbflow.sinks.upserts import lookup, upsert
from curbflow.sources.files import read_index
from curbflow.sources.tables import read_table, trips
from curbflow.sources.topics import Topics
from curbflow.streaming import jobs

PARTITIONS = 3
# Asked for by id; the last one is in no table.
LOOKUP_IDS = [3, 17, 42, 99, 150, 10**12]


def _timed_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return common.points(spark, sf_dir).withColumn("timestamp", arrival_text("ts"))


def enriched_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = jobs.enriched_messages(_timed_points(spark, sf_dir), common.centres())
    return messages.select("key", "value", "topic")


def partitioned_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages written to an explicit partition of their topic and read back from there."""
    assigned = common.assigned(spark, sf_dir).withColumn("time_stamp", iso_text("ts"))
    messages = to_messages(
        assigned,
        "clusters",
        delimited(["trip_id", "cluster", "time_stamp"]),
        key=F.col("cluster"),
        partition=F.pmod("cluster", F.lit(PARTITIONS)),
    )
    folder = scratch_path(spark, "partitioned")
    write_topics(messages, Topics("parquet", folder))
    return spark.read.parquet(folder).select("topic", "partition", "key", "value")


def filtered_json_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = jobs.trip_messages(trips(spark, sf_dir))
    return jobs.republished_messages(messages).select("topic", "value")


def routed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages per topic when a key of the record picks the topic."""
    routed = route_topic(trips(spark, sf_dir).drop("topic"), ["users", "cars"], F.col("trip_id"))
    return routed.groupBy("topic").agg(F.count("*").alias("n"), F.sum("trip_id").alias("ids"))


def document_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents numbered in arrival order, with the type that follows from their topic."""
    t = trips(spark, sf_dir).select("trip_id", "topic", "ts")
    numbered = with_doc_id(spark, t, ["ts", "trip_id"])
    return numbered.select("doc_id", "trip_id", "topic", doc_type("topic").alias("doc_type"))


def event_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned = common.assigned(spark, sf_dir).withColumn("time_stamp", iso_text("ts"))
    documents = to_event_document(assigned)
    return documents.select(
        "cluster",
        F.col("location.lat").alias("lat"),
        F.col("location.lon").alias("lon"),
        "time_stamp",
    )


def index_append_reruns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch appended twice without ids: the index holds every document twice."""
    path = scratch_path(spark, "events")
    documents = to_event_document(common.assigned(spark, sf_dir).withColumn("time_stamp", iso_text("ts")))
    append_index(documents, path)
    append_index(documents, path)
    return read_index(spark, path).groupBy("cluster").agg(F.count("*").alias("docs"))


def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations indexed by id: later turns replace earlier ones."""
    turns = read_table(spark, sf_dir, "conversations")
    stored = latest_by_id(turns.filter("turn < 2"), "conv_id", ["turn"])
    return upsert_index(stored, turns.filter("turn >= 2"), "conv_id", ["turn"])


def index_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through a stored index of which only the touched buckets are rewritten."""
    turns = read_table(spark, sf_dir, "conversations")
    path = scratch_path(spark, "conversations")
    merge_into_index(spark, path, turns.filter("turn < 2"), "conv_id", ["turn"], buckets=8)
    merge_into_index(spark, path, turns.filter("turn >= 2"), "conv_id", ["turn"], buckets=8)
    return read_index(spark, path).select("conv_id", "turn", "role", "text")


def index_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents found by id in an index of two commits, from the buckets of these ids alone."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    path = scratch_path(spark, "documents")
    upsert(spark, path, docs.withColumn("version", F.lit(1)).withColumn("n_chars", -F.col("n_chars")), "doc_id", ["version"])
    upsert(spark, path, docs.withColumn("version", F.lit(2)), "doc_id", ["version"])
    return lookup(spark, path, LOOKUP_IDS).drop("version")


def index_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_topic = counts_by(trips(spark, sf_dir), "topic")
    return by_topic.union(count_indices(
        {
            "documents": read_table(spark, sf_dir, "documents"),
            "conversations": read_table(spark, sf_dir, "conversations"),
        }
    ))


QUERIES = {
    f.__name__: f
    for f in (
        enriched_messages,
        partitioned_messages,
        filtered_json_messages,
        routed_counts,
        document_ids,
        event_documents,
        index_append_reruns,
        upsert_latest,
        index_merge,
        index_lookup,
        index_counts,
    )
}

_LATEST = """SELECT conv_id, turn, role, text FROM conversations
QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1"""

ORACLES = {
    "enriched_messages": f"""WITH {common.SQL_ASSIGNED}
SELECT CAST(cluster AS VARCHAR) AS key,
  cluster || ',' || CAST(lat AS VARCHAR) || ',' || CAST(lon AS VARCHAR) || ',' || {common.SQL_ISO} AS value,
  'usersenriched' AS topic FROM assigned WHERE topic = 'users'""",
    "partitioned_messages": f"""WITH {common.SQL_ASSIGNED}
SELECT 'clusters' AS topic, CAST(cluster % {PARTITIONS} AS INTEGER) AS partition,
  CAST(cluster AS VARCHAR) AS key,
  trip_id || ',' || cluster || ',' || {common.SQL_ISO} AS value FROM assigned""",
    "filtered_json_messages": f"""WITH {common.SQL_TRIPS}
SELECT 'cars' AS topic, '{{"timestamp":"' || {common.SQL_ARRIVAL} || '","trip_distance":"' || trip_distance
  || '","pickup_longitude":"' || pickup_longitude || '","pickup_latitude":"' || pickup_latitude
  || '","dropoff_longitude":"' || dropoff_longitude || '","dropoff_latitude":"' || dropoff_latitude
  || '"}}' AS value
FROM trips WHERE pickup_latitude > 40 AND pickup_latitude < 41
  AND pickup_longitude > -74 AND pickup_longitude < -73""",
    "routed_counts": f"""WITH {common.SQL_TRIPS}
SELECT CASE WHEN trip_id % 2 = 0 THEN 'users' ELSE 'cars' END AS topic, count(*) AS n,
  CAST(sum(trip_id) AS BIGINT) AS ids FROM trips GROUP BY 1""",
    "document_ids": f"""WITH {common.SQL_TRIPS}
SELECT row_number() OVER (ORDER BY ts, trip_id) AS doc_id, trip_id, topic,
  left(topic, length(topic) - 1) AS doc_type FROM trips""",
    "event_documents": f"""WITH {common.SQL_ASSIGNED}
SELECT CAST(cluster AS INTEGER) AS cluster, lat, lon, {common.SQL_ISO} AS time_stamp FROM assigned""",
    "index_append_reruns": f"""WITH {common.SQL_ASSIGNED}
SELECT CAST(cluster AS INTEGER) AS cluster, 2 * count(*) AS docs FROM assigned GROUP BY 1""",
    "upsert_latest": _LATEST,
    "index_merge": _LATEST,
    "index_lookup": f"""SELECT doc_id, lang, source, n_chars FROM documents
WHERE doc_id IN ({', '.join(map(str, LOOKUP_IDS))})""",
    "index_counts": f"""WITH {common.SQL_TRIPS}
SELECT topic AS "index", count(*) AS docs FROM trips GROUP BY 1
UNION ALL SELECT 'documents', count(*) FROM documents
UNION ALL SELECT 'conversations', count(*) FROM conversations""",
}
