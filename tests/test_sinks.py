import os
import random

import pytest
from pyspark.sql import functions as F

from curbflow.functions import predicates as p
from curbflow.operators import clean, routing, search
from curbflow.schemas import (
    CLUSTER_MAPPING,
    EVENT_MAPPING,
    PREDICTION_MAPPING,
    TRIP_MAPPING,
    mapping_type,
)
from curbflow.session import CHECKPOINT_CONF, scratch_path, shared_dir
from curbflow.sinks import index
from curbflow.sinks.archive import archive_points
from curbflow.sinks.streams import start


def test_typed_index_life_cycle(spark, tmp_path):
    name = "life_cycle"
    index.drop_index(spark, name)
    index.create_index(spark, name, EVENT_MAPPING, str(tmp_path / "ix"))
    index.create_index(spark, name, CLUSTER_MAPPING, str(tmp_path / "other"))
    assert spark.table(name).schema.simpleString() == mapping_type(EVENT_MAPPING).simpleString()
    assert name in index.list_indices(spark)
    assert index.index_counts({name: spark.table(name)}).collect() == [(name, 0)]
    index.drop_index(spark, name)
    index.drop_index(spark, name)
    assert name not in index.list_indices(spark)


def test_mapping_casts_what_fits(spark):
    df = spark.createDataFrame(
        [
            ("3", "41.12,-71.34", "2017-02-20T02:12:13.610"),
            ("x", "[-71.34,41.12]", "2017-02-20 02:12:13.610"),
            (None, None, None),
        ],
        "cluster string, location string, time_stamp string",
    )
    rows = index.apply_mapping(df, EVENT_MAPPING).collect()
    assert [r["cluster"] for r in rows] == [3, None, None]
    assert [r["location"] and r["location"]["lat"] for r in rows] == [41.12, 41.12, None]
    assert [r["time_stamp"] is not None for r in rows] == [True, False, False]
    for mapping in (CLUSTER_MAPPING, TRIP_MAPPING, PREDICTION_MAPPING):
        assert index.apply_mapping(df, mapping).schema.simpleString() == mapping_type(mapping).simpleString()


def versions(spark, rows):
    return spark.createDataFrame(rows, "id long, at int, text string")


def test_upsert_replaces_only_updated_ids(spark):
    stored = versions(spark, [(1, 1, "a"), (2, 1, "b")])
    updates = versions(spark, [(2, 3, "new"), (2, 2, "older"), (3, 1, "c"), (3, 1, "d")])
    got = index.upsert_index(stored, updates, "id", ["at"]).collect()
    assert sorted(map(tuple, got)) == [(1, 1, "a"), (2, 3, "new"), (3, 1, "d")]


def test_hot_id_upsert_equals_brute_force(spark):
    draw = random.Random(4)
    # one id holds a third of the rows
    rows = [(0 if i % 3 == 0 else draw.randrange(1, 500), i, f"v{i}") for i in range(6000)]
    want = {}
    for id, at, text in rows:
        want[id] = (id, at, text)
    got = index.latest_by_id(versions(spark, rows), "id", ["at"])
    assert sorted(map(tuple, got.collect())) == sorted(want.values())


def test_merge_is_repeatable_and_touches_few_buckets(spark, tmp_path):
    path = str(tmp_path / "ix")
    index.merge_into_index(spark, path, versions(spark, [(i, 1, f"a{i}") for i in range(200)]), "id", ["at"], 16)

    def files():
        return {d: sorted(os.listdir(f"{path}/{d}")) for d in os.listdir(path) if d.startswith("_bucket=")}

    before = files()
    for _ in range(2):
        index.merge_into_index(spark, path, versions(spark, [(7, 2, "new"), (7, 1, "late")]), "id", ["at"], 16)
    rows = {r["id"]: r["text"] for r in spark.read.parquet(path).collect()}
    assert len(rows) == 200 and rows[7] == "new" and rows[8] == "a8"
    assert sum(before[d] != files()[d] for d in before) == 1


@pytest.mark.parametrize("marked", [True, False])
def test_another_bucket_number_is_refused(spark, tmp_path, marked):
    """From 64 to 32 buckets half of all rows lie in the bucket of both numbers."""
    path = str(tmp_path / "ix")
    index.merge_into_index(spark, path, versions(spark, [(i, 1, "a") for i in range(300)]), "id", ["at"], 64)
    if not marked:
        os.remove(f"{path}/_buckets-64")
    for wrong in (32, 128, 63):
        with pytest.raises(ValueError):
            index.merge_into_index(spark, path, versions(spark, [(7, 2, "new")]), "id", ["at"], wrong)
    index.merge_into_index(spark, path, versions(spark, [(7, 2, "new")]), "id", ["at"], 64)
    assert spark.read.parquet(path).count() == 300 and os.path.exists(f"{path}/_buckets-64")


def test_archive_rolls_and_loses_nothing(spark, tmp_path):
    df = spark.range(0, 2500, 1, 1).select(F.col("id").cast("double").alias("lat"), F.lit(None).cast("double").alias("lon"))
    archive_points(df, str(tmp_path / "a"), max_records=1000)
    files = [f for f in os.listdir(tmp_path / "a") if f.endswith(".txt")]
    assert len(files) == 3
    lines = spark.read.text(str(tmp_path / "a"))
    assert lines.count() == 2500 and lines.filter("value = '[7.0,0]'").count() == 1


def test_console_preview_runs(spark, tmp_path):
    stream = spark.readStream.schema("value string").text(str(tmp_path))
    start(stream, "console", interval=None).awaitTermination()


def test_document_numbers_equal_a_global_sort(spark):
    draw = random.Random(3)
    # a third of the rows share the first ordering column
    rows = [(0 if i % 3 == 0 else draw.randrange(1000), draw.random(), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "a int, b double, c int").repartition(7)
    got = routing.with_doc_id(spark, df, ["a", "b", "c"], "n").collect()
    want = {r: i for i, r in enumerate(sorted(rows), 1)}
    assert {tuple(r)[:3]: r["n"] for r in got} == want


def test_hash_ids_are_stable(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (1, "a")], "x int, y string")
    ids = [r["doc_id"] for r in routing.with_hash_id(df, ["x", "y"]).collect()]
    assert ids[0] == ids[2] != ids[1]


def test_routes(spark):
    df = spark.range(2000)
    keyed = routing.route_topic(df, ["a", "b", "c"], F.col("id")).groupBy("topic").count().collect()
    assert {r["topic"]: r["count"] for r in keyed} == {"a": 667, "b": 667, "c": 666}
    drawn = {r["topic"]: r["count"] for r in routing.route_topic(df, ["a", "b"], seed=1).groupBy("topic").count().collect()}
    assert set(drawn) == {"a", "b"} and min(drawn.values()) > 850


def test_defaults_and_drops(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), "t"), (None, "t"), (2.0, "t")], "x double, s string")
    assert [r["x"] for r in clean.drop_null_points(df, ["x", "s"]).collect()] == [2.0]
    assert clean.default_coords(df, ["x"]).filter("x = 0").count() == 2
    stamped = clean.default_time(df, "s").collect()
    assert len(stamped[0]["s"]) == len("2024-01-01 00:00:00.000") and stamped[1]["s"] == "t"
    assert clean.non_empty(spark.createDataFrame([("",), (None,), ("a",)], "s string"), "s").count() == 1


def test_text_match(spark):
    texts = ["The search", "research", "SEARCHING", "all-about", "", None, "x search.", "überall", "all_about"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    hits = [r["t"] for r in df.filter(p.match_text("t", "all Search!")).collect()]
    assert hits == ["The search", "all-about", "x search.", "all_about"]
    assert df.filter(p.match_text("t", "Überall")).count() == 1
    assert df.filter(p.match_text("t", "  ")).count() == 0


def test_lookup_by_ids(spark):
    df = spark.range(5000).withColumnRenamed("id", "_id")
    assert search.get_by_ids(df, [3, 4, -1]).count() == 2
    assert search.get_by_ids(df, list(range(-5, 1200))).count() == 1200
    assert search.get_by_ids(df, df.filter("_id % 2 = 0")).count() == 2500


def test_search_without_predicate_and_recent_days(spark):
    df = spark.range(10)
    assert [r["id"] for r in search.search(df, None, ["id"], 3).collect()] == [0, 1, 2]
    recent = spark.range(10).withColumn("ts", F.expr("current_timestamp() - make_interval(0, 0, 0, CAST(id AS INT))"))
    assert clean.last_days(recent, "ts", 7).count() in (7, 8)


def test_scratch_is_under_the_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(shared_dir(spark))
    assert spark.conf.get(CHECKPOINT_CONF)
