"""The streaming jobs, run over what the tables hold and read back from their sinks."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.functions.text import arrival_text
from curbflow.operators.metrics import tumbling_counts
from curbflow.plans import clustering, common, publish, spatial
from curbflow.session import scratch_path
from curbflow.sinks.archive import read_archive, stream_archive, stream_folded_archive
from curbflow.sinks.index import stream_index
from curbflow.sinks.messages import stream_topics, write_topics
from curbflow.sinks.numbering import read_numbered, stream_numbered
from curbflow.sinks.upserts import read_upserts, stream_upserts
from curbflow.sources.files import read_index
from curbflow.sources.tables import as_trips, read_table, stream_table, trips
from curbflow.sources.topics import Topics, read_topics
from curbflow.streaming import jobs, live, training

DELAY = "1 hour"
EVERY = timedelta(days=5)
ARRIVALS = 5


class Run:
    """Folders of one run of a job, and the stream of messages that feeds it."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = scratch_path(spark, name)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def topic_folder(self, name: str) -> Topics:
        return Topics("parquet", self.path(name))

    def finish(self, query) -> None:
        query.awaitTermination()

    def messages(self, sf_dir: str) -> DataFrame:
        """The stream of trip messages of both topics."""
        return jobs.trip_messages(as_trips(stream_table(self.spark, sf_dir, "events")))


def stream_tumbling_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily counts per topic of a watermarked stream; closed windows only."""
    run = Run(spark, "tumbling")
    trips = as_trips(stream_table(spark, sf_dir, "events")).withColumn("ts", F.col("ts").cast("timestamp"))
    counts = tumbling_counts(trips.withWatermark("ts", DELAY), "1 day")
    run.finish(stream_index(counts, run.path("index"), run.path("checkpoint"), interval=None))
    return read_index(spark, run.path("index")).select(
        F.date_format("window_start", "yyyy-MM-dd").alias("window_start"), "topic", "n"
    )


def stream_supply_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From JSON messages to cluster documents per day."""
    run = Run(spark, "supply-demand")
    points = jobs.trip_points(run.messages(sf_dir))
    documents = jobs.supply_demand_documents(points, common.centres(), "1 day", DELAY)
    run.finish(stream_index(documents, run.path("index"), run.path("checkpoint"), interval=None))
    return read_index(spark, run.path("index")).select(
        F.date_format("window_start", "yyyy-MM-dd").alias("window_start"),
        "cluster",
        "u_count",
        "c_count",
        F.round("ratio", 6).alias("ratio"),
        "lat",
        "lon",
    )


def stream_enriched_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two chained jobs: points to the enriched topic, the enriched topic to a typed index."""
    run = Run(spark, "enriched")
    folder = run.topic_folder("topics")
    enriched = jobs.enriched_messages(jobs.trip_points(run.messages(sf_dir)), common.centres())
    run.finish(stream_topics(enriched, folder, run.path("checkpoint-1"), interval=None))
    arrived = read_topics(spark, folder, [jobs.ENRICHED], streaming=True)
    documents = jobs.enriched_documents(arrived)
    run.finish(stream_index(documents, run.path("index"), run.path("checkpoint-2"), interval=None))
    return read_index(spark, run.path("index")).select(
        "cluster",
        F.col("location.lat").alias("lat"),
        F.col("location.lon").alias("lon"),
        arrival_text("time_stamp").alias("time_stamp"),
    )


def stream_event_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed event documents of the cars topic."""
    run = Run(spark, "events")
    documents = jobs.event_documents(jobs.trip_points(run.messages(sf_dir)), common.centres(), jobs.CARS)
    run.finish(stream_index(documents, run.path("index"), run.path("checkpoint"), interval=None))
    return read_index(spark, run.path("index")).select(
        "cluster",
        F.col("location.lat").alias("lat"),
        F.col("location.lon").alias("lon"),
        arrival_text("time_stamp").alias("time_stamp"),
    )


def stream_filter_republish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two topics filtered by box and published to one."""
    run = Run(spark, "republish")
    folder = run.topic_folder("topics")
    kept = jobs.republished_messages(run.messages(sf_dir))
    run.finish(stream_topics(kept, folder, run.path("checkpoint"), interval=None))
    return read_topics(spark, folder, [jobs.CARS]).select("topic", "value")


def republished_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Republished messages, whose numbers are text, read back as points."""
    run = Run(spark, "roundtrip")
    folder = run.topic_folder("topics")
    messages = jobs.trip_messages(trips(spark, sf_dir))
    write_topics(jobs.republished_messages(messages), folder)
    points = jobs.trip_points(read_topics(spark, folder, [jobs.CARS]))
    return points.select("lat", "lon", "trip_distance", arrival_text("ts").alias("timestamp"))


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a stream of messages, some cut short, keeps and what goes to quarantine, and why."""
    run = Run(spark, "quarantine")
    cut = F.when(F.col("key").cast("long") % 83 == 0, F.expr("left(value, 20)")).otherwise(F.col("value"))
    messages = run.messages(sf_dir).withColumn("value", cut)
    lost = jobs.quarantined_messages(messages)
    run.finish(stream_index(lost, run.path("lost"), run.path("checkpoint-1"), interval=None))
    kept = jobs.trip_points(messages).select("topic", "trip_id", "ts")
    run.finish(stream_index(kept, run.path("kept"), run.path("checkpoint-2"), interval=None))
    good = read_index(spark, run.path("kept")).select("topic", F.lit("none").alias("reason"))
    every = good.union(read_index(spark, run.path("lost")).select("topic", "reason"))
    return every.groupBy("topic", "reason").agg(F.count("*").alias("n"))


def stream_trip_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Geohash documents of both topics."""
    run = Run(spark, "trip-index")
    documents = jobs.trip_documents(run.messages(sf_dir), common.NOW)
    run.finish(stream_index(documents, run.path("index"), run.path("checkpoint"), interval=None))
    return read_index(spark, run.path("index"))


def stream_point_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pickups as text lines, 0 for missing coordinates."""
    run = Run(spark, "archive")
    trips, _ = jobs.decoded_trips(run.messages(sf_dir))
    query = stream_archive(
        trips,
        run.path("points"),
        run.path("checkpoint"),
        "pickup_latitude",
        "pickup_longitude",
        interval=None,
    )
    run.finish(query)
    lines = spark.read.text(run.path("points"))
    return lines.groupBy(F.col("value").alias("line")).agg(F.count("*").alias("n"))


def _live(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """Five-day batches arrive one after the other, and the stream is started anew for each."""
    run = Run(spark, "live")
    points = common.points(spark, sf_dir).select("topic", "lat", "lon", clustering.batch_number("ts").alias("b"))
    points.write.partitionBy("b").parquet(run.path("points"))
    schema = "topic string, lat double, lon double"
    for r in spark.read.parquet(run.path("points")).select("b").distinct().orderBy("b").collect():
        spark.read.schema(schema).parquet(f"{run.path('points')}/b={r['b']}").write.mode("append").parquet(run.path("arrived"))
        arrived = spark.readStream.schema(schema).parquet(run.path("arrived"))
        run.finish(live.stream_live_model(arrived, run.path("out"), run.path("checkpoint"), common.centres(), clustering.DECAY, None))
    return spark.read.parquet(run.path(f"out/{table}"))


def stream_live_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model after each micro-batch of a stream that trains while it runs."""
    rounded = [F.round(c, 6).alias(c) for c in ("lat", "lon", "weight")]
    return _live(spark, sf_dir, "models").select(F.col("batch").cast("int"), "cluster", *rounded)


def stream_batch_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users, cars and their ratio for each cluster of each micro-batch, by the model it has learned."""
    return _live(spark, sf_dir, "ratios").select(F.col("batch").cast("int"), "cluster", "u_count", "c_count", F.round("ratio", 6).alias("ratio"))


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations upserted by id while their turns arrive out of order, the stream started anew
    for each arrival; buckets of more than two folders are folded on the way."""
    run = Run(spark, "upsert")
    turns = read_table(spark, sf_dir, "conversations")
    turns.withColumn("arrival", F.pmod(F.col("turn") * 2 + 1, F.lit(ARRIVALS))).write.partitionBy("arrival").parquet(run.path("turns"))
    for i in range(ARRIVALS):
        # a number that no turn has gives an arrival without rows
        spark.read.parquet(run.path("turns")).filter(F.col("arrival") == i).drop("arrival").write.mode("append").parquet(run.path("arrived"))
        arrived = spark.readStream.schema(turns.schema).parquet(run.path("arrived"))
        run.finish(stream_upserts(arrived, run.path("index"), run.path("checkpoint"), "conv_id", ["turn"], 8, None, above=2))
    return read_upserts(spark, run.path("index")).select("conv_id", "turn", "role", "text")


def stream_document_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of documents that go on over arrivals, the stream started anew for each."""
    run = Run(spark, "numbers")
    events = read_table(spark, sf_dir, "events").select("event_id", "event_type", (F.col("event_id") % 3).alias("arrival"))
    events.write.partitionBy("arrival").parquet(run.path("events"))
    schema = events.drop("arrival").schema
    for i in range(3):
        spark.read.schema(schema).parquet(f"{run.path('events')}/arrival={i}").write.mode("append").parquet(run.path("arrived"))
        arrived = spark.readStream.schema(schema).parquet(run.path("arrived"))
        run.finish(stream_numbered(arrived, run.path("numbered"), run.path("checkpoint"), ["event_id"], interval=None))
    return read_numbered(spark, run.path("numbered")).select("doc_id", "event_id", "event_type")


def stream_folded_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The point archive of many micro-batches, whose small folders are joined on the way."""
    run = Run(spark, "folded")
    pickups = trips(spark, sf_dir).select("pickup_latitude", "pickup_longitude")
    pickups.repartition(8).write.parquet(run.path("arrived"))
    arrived = spark.readStream.schema(pickups.schema).option("maxFilesPerTrigger", 1).parquet(run.path("arrived"))
    places = ("pickup_latitude", "pickup_longitude")
    run.finish(stream_folded_archive(arrived, run.path("points"), run.path("checkpoint"), *places, above=3, interval=None))
    lines = read_archive(spark, run.path("points"))
    return lines.groupBy(F.col("value").alias("line")).agg(F.count("*").alias("n"))


def _trained(run: Run, sf_dir: str) -> list:
    points = jobs.trip_points(run.messages(sf_dir))
    run.finish(training.land_points(points, run.path("landed"), run.path("checkpoint"), "day", None))
    return training.train_closed_windows(
        run.spark,
        run.path("landed"),
        run.path("models"),
        common.centres(),
        EVERY,
        clustering.DECAY,
        timedelta(hours=1),
        grain="day",
    )


def stream_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points landed by a stream, the model folded over the closed five-day windows."""
    run = Run(spark, "training")
    _trained(run, sf_dir)
    models = spark.read.parquet(run.path("models"))
    return models.select(
        F.date_format("batch", "yyyy-MM-dd").alias("batch"),
        "cluster",
        F.round("lat", 6).alias("lat"),
        F.round("lon", 6).alias("lon"),
        F.round("weight", 6).alias("weight"),
    )


def stream_trained_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demand and supply of the closed windows, each by the model that learned it."""
    run = Run(spark, "trained-documents")
    _trained(run, sf_dir)
    folders = (run.path("landed"), run.path("models"), run.path("index"))
    training.publish_closed_windows(spark, *folders, len(common.CENTRE_COORDS), EVERY, "day")
    return read_index(spark, run.path("index")).select(
        F.date_format("batch", "yyyy-MM-dd").alias("batch"),
        "cluster",
        "u_count",
        "c_count",
        F.round("ratio", 6).alias("ratio"),
        F.round("lat", 6).alias("lat"),
        F.round("lon", 6).alias("lon"),
    )


def _published(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    run = Run(spark, f"trained-{name}")
    _trained(run, sf_dir)
    folders = (run.path("landed"), run.path("models"), run.path("out"))
    training.publish_trained(spark, *folders, len(common.CENTRE_COORDS), EVERY, "day")
    return training.read_published(spark, run.path(f"out/{name}")).withColumn("batch", F.date_format("batch", "yyyy-MM-dd"))


def trained_event_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed event documents of both topics, by the model that learned their window."""
    return _published(spark, sf_dir, "events").select(
        "batch",
        "topic",
        "cluster",
        F.col("location.lat").alias("lat"),
        F.col("location.lon").alias("lon"),
        arrival_text("time_stamp").alias("time_stamp"),
    )


def trained_enriched_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text messages of the user points with their trained cluster."""
    messages = _published(spark, sf_dir, "enriched")
    parts = F.split("value", ",")
    return messages.select(
        "batch", "topic", "key", F.get(parts, 1).cast("double").alias("lat"), F.get(parts, 2).cast("double").alias("lon"), F.get(parts, 3).alias("time_stamp")
    )


def trained_cluster_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed cluster documents with their place as a geo point."""
    return _published(spark, sf_dir, "clusters").select(
        "batch",
        "cluster",
        "u_count",
        "c_count",
        F.round("ratio", 6).alias("ratio"),
        F.round("location.lat", 6).alias("lat"),
        F.round("location.lon", 6).alias("lon"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        stream_tumbling_counts,
        stream_supply_demand,
        stream_live_training,
        stream_batch_ratios,
        stream_upsert,
        stream_document_ids,
        stream_folded_points,
        stream_enriched_index,
        stream_event_index,
        stream_filter_republish,
        republished_roundtrip,
        stream_quarantine,
        stream_trip_index,
        stream_point_archive,
        stream_training,
        stream_trained_documents,
        trained_event_documents,
        trained_enriched_messages,
        trained_cluster_documents,
    )
}

_CLOSED = "date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM {source}) - INTERVAL 1 HOUR"
_FOLD = clustering._sql_fold()
_WINDOW_S = EVERY.days * 86400
_TRAINED = (
    f"closed AS (SELECT * FROM history WHERE (b + 1) * {_WINDOW_S}"
    " <= (SELECT epoch(max(ts)) FROM points) - 3600)"
)

_RESULT = f"{_FOLD}, {_TRAINED}, {common.sql_assign('placed', 'closed', 'result', 'p.b = c.b')}"

ORACLES = {
    "trained_event_documents": f"""WITH {_RESULT}
SELECT {clustering._sql_batch('b')} AS batch, topic, CAST(cluster AS INTEGER) AS cluster, lat, lon,
  {common.SQL_ARRIVAL} AS time_stamp FROM result""",
    "trained_enriched_messages": f"""WITH {_RESULT}
SELECT {clustering._sql_batch('b')} AS batch, 'usersenriched' AS topic, CAST(cluster AS VARCHAR) AS key, lat, lon,
  {common.SQL_ISO} AS time_stamp FROM result WHERE topic = 'users'""",
    "republished_roundtrip": f"""WITH {common.SQL_TRIPS}
SELECT dropoff_latitude AS lat, dropoff_longitude AS lon, trip_distance, {common.SQL_ARRIVAL} AS timestamp
FROM trips WHERE pickup_latitude > 40 AND pickup_latitude < 41 AND pickup_longitude > -74 AND pickup_longitude < -73""",
    "stream_quarantine": f"""WITH {common.SQL_ALL_POINTS}
SELECT topic, CASE WHEN trip_id % 83 = 0 THEN 'json' WHEN lat IS NULL OR lon IS NULL THEN 'place' ELSE 'none' END AS reason,
  count(*) AS n FROM all_points GROUP BY ALL""",
    "stream_filter_republish": publish.ORACLES["filtered_json_messages"],
    "stream_trip_index": spatial.ORACLES["trip_documents"],
    "stream_tumbling_counts": f"""WITH {common.SQL_TRIPS}
SELECT strftime(ts, '%Y-%m-%d') AS window_start, topic, count(*) AS n FROM trips
WHERE {_CLOSED.format(source='trips')} GROUP BY ALL""",
    "stream_document_ids": """SELECT row_number() OVER (ORDER BY event_id % 3, event_id) AS doc_id, event_id, event_type
FROM events""",
    "stream_upsert": publish.ORACLES["upsert_latest"],
    "stream_live_training": clustering.SQL_LIVE_MODELS,
    "stream_batch_ratios": clustering.SQL_BATCH_RATIOS,
    "stream_supply_demand": f"""WITH {common.SQL_ASSIGNED}, counted AS (
  SELECT strftime(ts, '%Y-%m-%d') AS window_start, cluster,
    count(*) FILTER (topic = 'users') AS u_count, count(*) FILTER (topic = 'cars') AS c_count
  FROM assigned WHERE {_CLOSED.format(source='points')} GROUP BY ALL)
SELECT window_start, CAST(c.cluster AS INTEGER) AS cluster, u_count, c_count,
  round(CAST(u_count AS DOUBLE) / c_count, 6) AS ratio, clat AS lat, clon AS lon
FROM counted c JOIN centres USING (cluster) WHERE u_count > 0 AND c_count > 0""",
    "stream_enriched_index": f"""WITH {common.SQL_ASSIGNED}
SELECT CAST(cluster AS INTEGER) AS cluster, lat, lon, {common.SQL_ARRIVAL} AS time_stamp
FROM assigned WHERE topic = 'users'""",
    "stream_event_index": f"""WITH {common.SQL_ASSIGNED}
SELECT CAST(cluster AS INTEGER) AS cluster, lat, lon, {common.SQL_ARRIVAL} AS time_stamp
FROM assigned WHERE topic = 'cars'""",
    "stream_point_archive": f"""WITH {common.SQL_TRIPS}
SELECT '[' || coalesce(CAST(pickup_latitude AS VARCHAR), '0') || ','
  || coalesce(CAST(pickup_longitude AS VARCHAR), '0') || ']' AS line, count(*) AS n FROM trips GROUP BY 1""",
    "stream_training": f"""WITH {_FOLD}, {_TRAINED}
SELECT {clustering._sql_batch('b')} AS batch, CAST(cluster AS INTEGER) AS cluster, round(clat, 6) AS lat,
  round(clon, 6) AS lon, round(w, 6) AS weight FROM closed""",
    "stream_trained_documents": f"""WITH {_FOLD}, {_TRAINED},
{common.sql_assign('placed', 'closed', 'result', 'p.b = c.b')}, counted AS (
  SELECT b, cluster, count(*) FILTER (topic = 'users') AS u_count, count(*) FILTER (topic = 'cars') AS c_count
  FROM result GROUP BY ALL)
SELECT {clustering._sql_batch('c.b')} AS batch, CAST(c.cluster AS INTEGER) AS cluster, u_count, c_count,
  round(CAST(u_count AS DOUBLE) / c_count, 6) AS ratio, round(clat, 6) AS lat, round(clon, 6) AS lon
FROM counted c JOIN closed m ON c.b = m.b AND c.cluster = m.cluster WHERE u_count > 0 AND c_count > 0""",
}
ORACLES["trained_cluster_documents"] = ORACLES["stream_trained_documents"]
ORACLES["stream_folded_points"] = ORACLES["stream_point_archive"]
