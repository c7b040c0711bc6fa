"""Streams in several micro-batches and restarts give what one batch gives."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from curbflow.operators import cluster as c
from curbflow.plans import clustering, common
from curbflow.sinks.index import stream_index
from curbflow.sinks.messages import stream_topics, write_topics
from curbflow.sources.tables import trips
from curbflow.sources.topics import Topics, read_topics
from curbflow.streaming import jobs, live, training


@pytest.fixture(scope="module")
def messages(spark, sf_dir):
    return jobs.trip_messages(trips(spark, sf_dir))


@pytest.fixture()
def topics(spark, messages, tmp_path):
    """The messages as three files per topic, in time order, read one file per micro-batch."""
    folder = Topics("parquet", str(tmp_path / "topics"), {"maxFilesPerTrigger": "1"})
    for third in range(3):
        day = F.expr("int(substring(get_json_object(value, '$.timestamp'), 9, 2))")
        inside = (day > third * 10) & (day <= (third + 1) * 10 + third // 2)
        write_topics(messages.filter(inside).coalesce(1), folder)
    return folder


def rows(df, columns):
    return sorted(map(tuple, df.select(*columns).collect()))


def test_enriched_topology_in_micro_batches_and_restarts(spark, messages, topics, tmp_path):
    out = Topics("parquet", str(tmp_path / "enriched"))
    index = str(tmp_path / "index")
    for _ in range(2):  # the second run finds nothing new
        points = jobs.trip_points(read_topics(spark, topics, ["users", "cars"], streaming=True))
        first = stream_topics(jobs.enriched_messages(points, common.centres()), out, str(tmp_path / "c1"), None)
        first.awaitTermination()
        arrived = read_topics(spark, out, [jobs.ENRICHED], streaming=True)
        second = stream_index(jobs.enriched_documents(arrived), index, str(tmp_path / "c2"), None)
        second.awaitTermination()
    batch = jobs.enriched_documents(jobs.enriched_messages(jobs.trip_points(messages), common.centres()))
    columns = ["cluster", "location.lat", "location.lon", "time_stamp"]
    assert rows(spark.read.parquet(index), columns) == rows(batch, columns)
    assert batch.count() > 0


def test_ratio_stream_equals_batch_on_closed_windows(spark, messages, topics, tmp_path):
    points = jobs.trip_points(read_topics(spark, topics, ["users", "cars"], streaming=True))
    # topic folders arrive one after the other, so allow for the whole time span
    documents = jobs.supply_demand_documents(points, common.centres(), "1 day", "31 days")
    stream_index(documents, str(tmp_path / "ix"), str(tmp_path / "c"), None).awaitTermination()
    got = spark.read.schema(documents.schema).parquet(str(tmp_path / "ix"))
    assert got.count() == 0  # nothing is closed yet
    late = jobs.trip_messages(
        trips(spark, "/root/testdata/sf0.001").limit(1).withColumn("ts", F.expr("TIMESTAMP_NTZ '2024-06-01 00:00:00'"))
    )
    write_topics(late, Topics("parquet", topics.path))
    points = jobs.trip_points(read_topics(spark, topics, ["users", "cars"], streaming=True))
    documents = jobs.supply_demand_documents(points, common.centres(), "1 day", "31 days")
    stream_index(documents, str(tmp_path / "ix"), str(tmp_path / "c"), None).awaitTermination()
    batch = jobs.supply_demand_documents(jobs.trip_points(messages), common.centres(), "1 day", "31 days")
    columns = ["window_start", "cluster", "u_count", "c_count", "ratio", "lat", "lon"]
    assert rows(spark.read.parquet(str(tmp_path / "ix")), columns) == rows(batch, columns)


def test_training_in_steps_equals_one_fold(spark, messages, tmp_path):
    landed, models, index = (str(tmp_path / x) for x in ("landed", "models", "index"))
    every = timedelta(days=2)
    k = len(common.CENTRE_COORDS)
    source = Topics("parquet", str(tmp_path / "topics"))
    day = F.expr("int(substring(get_json_object(value, '$.timestamp'), 9, 2))")
    for low, high in ((1, 9), (10, 17), (18, 31)):
        write_topics(messages.filter(day.between(low, high)), source)
        for _ in range(2):  # a repeated step changes nothing
            points = jobs.trip_points(read_topics(spark, source, ["users", "cars"], streaming=True))
            training.land_points(points, landed, str(tmp_path / "c"), "day", None).awaitTermination()
            training.train_closed_windows(
                spark, landed, models, common.centres(), every, clustering.DECAY, grain="day"
            )
            training.publish_closed_windows(spark, landed, models, index, k, every, "day")
    got = spark.read.parquet(models)
    points = jobs.trip_points(messages)
    fold = list(c.train_windows(points.filter("topic = 'users'"), common.centres(), every, clustering.DECAY))
    want = c.history_df(spark, fold)
    columns = ["batch", "cluster", F.round("lat", 8), F.round("lon", 8), F.round("weight", 8)]
    trained = rows(got, columns)
    assert trained == rows(want, columns)[: len(trained)]
    assert len(trained) >= 13 * k
    documents = spark.read.parquet(index)
    assert documents.count() == documents.select("batch", "cluster").distinct().count() > 0
    assigned = c.assign_with_history(points, want, k, every)
    counts = assigned.groupBy("batch", "cluster").agg(F.count_if(F.col("topic") == "users").alias("u_count"))
    both = documents.join(counts.withColumnRenamed("u_count", "u"), ["batch", "cluster"])
    assert both.count() == documents.count() and both.filter("u <> u_count").count() == 0


def test_one_pass_trains_users_only_and_keeps_late_points_out(spark, tmp_path):
    landed = spark.createDataFrame(
        [("users", 1.0, 1.0, "2024-01-01 00:00:01"), ("cars", 9.0, 9.0, "2024-01-01 00:00:12")],
        "topic string, lat double, lon double, ts string",
    )
    place = lambda df: df.withColumn("ts", F.col("ts").cast("timestamp")).withColumn("part", F.date_format("ts", "yyyy-MM-dd-HH"))
    place(landed).write.partitionBy("part").parquet(str(tmp_path / "landed"))
    args = (spark, str(tmp_path / "landed"), str(tmp_path / "models"), c.given_centres([(0.0, 0.0)]), timedelta(seconds=5), 0.5)
    first = training.train_closed_windows(*args)
    assert [(s.second, m.coords, m.weights) for s, m in first] == [
        (0, ((1.0, 1.0),), (1.0,)),
        (5, ((1.0, 1.0),), (0.5,)),
    ]
    late = spark.createDataFrame([("users", 5.0, 5.0, "2024-01-01 00:00:02")], landed.schema)
    place(late).write.mode("append").partitionBy("part").parquet(str(tmp_path / "landed"))
    assert training.train_closed_windows(*args) == []
    assert training.latest_model(spark, str(tmp_path / "models"), 1)[1].weights == (0.5,)


def test_live_model_survives_a_failure_within_a_batch(spark, sf_dir, tmp_path, monkeypatch):
    """A batch that fails half way, and one that is run again, leave what a smooth run leaves."""
    points = common.points(spark, sf_dir).select("topic", "lat", "lon", clustering.batch_number("ts").alias("b"))
    parts = [r[0] for r in points.select("b").distinct().orderBy("b").collect()][:3]
    start, schema, source = common.centres(), "topic string, lat double, lon double", str(tmp_path / "in")

    def run(out):
        query = live.stream_live_model(spark.readStream.schema(schema).parquet(source), out, out + "-checkpoint", start, 0.9, None)
        query.awaitTermination()

    def tables(out):
        return [rows(spark.read.parquet(f"{out}/models"), ["batch", "cluster", "lat", "lon", "weight"]), rows(spark.read.parquet(f"{out}/ratios"), ["batch", "cluster", "u_count", "c_count"])]

    smooth, rough = str(tmp_path / "smooth"), str(tmp_path / "rough")
    for k, b in enumerate(parts):
        points.filter(F.col("b") == b).select("topic", "lat", "lon").write.mode("append").parquet(source)
        run(smooth)
        if k == 1:
            with monkeypatch.context() as broken:
                broken.setattr(c.Centres, "to_df", lambda *a: 1 / 0)  # after the ratios, before the model
                with pytest.raises(Exception):
                    run(rough)
            assert live.versions(spark, rough) == [0]
        run(rough)
    assert live.versions(spark, rough) == [0, 1, 2]
    once = tables(smooth)
    assert [[r[:2] for r in t] for t in tables(rough)] == [[r[:2] for r in t] for t in once]
    assert all(abs(x - y) < 1e-9 for a, b in zip(tables(rough), once) for p, q in zip(a, b) for x, y in zip(p, q))
    again = points.filter(F.col("b") == parts[1])
    live.batch_step(rough, start, 0.9)(again, 1)
    assert [[r[:2] for r in t] for t in tables(rough)] == [[r[:2] for r in t] for t in once]


def test_kept_and_quarantined_are_apart(spark):
    text = '{"VendorID": "1", "timestamp": "soon", "pickup_latitude": 40.5, "pickup_longitude": -73.9, "dropoff_latitude": 40.5, "dropoff_longitude": -73.9}'
    messages = spark.createDataFrame([("users", "1", text), ("cars", "2", "no json")], "topic string, key string, value string")
    assert jobs.trip_points(messages).count() == 0
    assert sorted(r["reason"] for r in jobs.quarantined_messages(messages).collect()) == ["json", "time"]
