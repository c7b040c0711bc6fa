from datetime import date, datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbflow.schemas import ENRICHED_FIELDS, MOVIE, PERSON, PERSON_DATE_FORMAT, TRIP_COLUMNS
from curbflow.sources.files import load_documents, read_point_files, read_trips_csv
from curbflow.sources.topics import (
    Topics,
    decode_delimited,
    decode_json,
    decode_or_quarantine,
    decode_or_text,
    read_topic,
    read_topics,
)
from curbflow.sinks.messages import to_json_record, to_messages, write_topics

N = len(TRIP_COLUMNS)


def row(*first):
    return ",".join([*map(str, first), *[""] * (N - len(first))])


def test_trip_file(spark, tmp_path):
    header = ",".join(TRIP_COLUMNS.names)
    lines = [
        header,
        "," * (N - 1),
        row("VTS", "2013-05-01 00:04:00", "2013-05-01 00:12:00", 1, "1.34", "-73.98", "40.77"),
        row("VTS", "2013-05-01 00:04:00") + ",one too many",
        row("VTS", "2013-05-01 00:04:00") + ",",
        "short,2013-05-01 00:05:00",
        "",
        row('"quoted, name"', "not a time", "", "many"),
        row("VTS", "2013-05-01 00:09:00"),
        row("VTS", "2013-05-01 00:09:00"),
    ]
    # lines end as Windows files end
    (tmp_path / "trips.csv").write_bytes("\r\n".join(lines).encode())
    got = read_trips_csv(spark, str(tmp_path / "trips.csv"))
    assert got.schema == TRIP_COLUMNS
    rows = got.collect()
    assert [r["vendor_id"] for r in rows] == [None, "VTS", "short", "quoted, name", "VTS", "VTS"]
    assert rows[1]["pickup_datetime"] == datetime(2013, 5, 1, 0, 4)
    assert (rows[1]["trip_distance"], rows[1]["pickup_latitude"], rows[1]["total_amount"]) == (1.34, 40.77, None)
    assert (rows[3]["pickup_datetime"], rows[3]["passenger_count"]) == (None, None)


def test_trip_file_of_the_later_layout(spark, tmp_path):
    lines = [
        "VendorID,tpep_pickup_datetime,extra,pickup_latitude,improvement_surcharge",
        "2,2016-01-01 00:00:00,0.5,40.7,0.3",
    ]
    for part in ("a.csv", "b.csv"):
        (tmp_path / part).write_text("\n".join(lines) + "\n")
    rows = read_trips_csv(spark, str(tmp_path)).collect()
    assert len(rows) == 2
    assert (rows[0]["vendor_id"], rows[0]["surcharge"], rows[0]["pickup_latitude"]) == ("2", 0.5, 40.7)
    assert rows[0]["dropoff_latitude"] is None


def test_empty_trip_file(spark, tmp_path):
    (tmp_path / "none.csv").write_text("")
    assert read_trips_csv(spark, str(tmp_path / "none.csv")).count() == 0


def test_point_files_in_batch_and_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "p.txt").write_text("[1.5,-2]\nnoise\n[3]\n[0,4.25]\n")
    want = [(0.0, 4.25), (1.5, -2.0)]
    assert sorted(map(tuple, read_point_files(spark, str(tmp_path / "in")).collect())) == want
    stream = read_point_files(spark, str(tmp_path / "in"), streaming=True)
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "c"))
        .trigger(availableNow=True)
        .start(str(tmp_path / "out"))
    )
    query.awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect())) == want


def test_documents_with_arrays_and_a_misnamed_field(spark, tmp_path):
    (tmp_path / "d.json").write_text(
        '{"_id": 1, "title": "A", "release_year": 1999, "genre": ["x", "y"], "actors": []}\n'
        '{"_id": 2, "title": "B", "release": 1999, "genre": ["z"], "description": "d"}\n'
    )
    rows = load_documents(spark, str(tmp_path / "d.json"), MOVIE).orderBy("_id").collect()
    assert [(r["release_year"], r["genre"], r["actors"]) for r in rows] == [
        (1999, ["x", "y"], []),
        (None, ["z"], None),
    ]


def test_nested_document(spark, tmp_path):
    (tmp_path / "p.json").write_text(
        '{"email": "a@b.c", "first_name": "A", "last_name": "B",'
        ' "info": {"bio": "t", "age": 30, "interests": ["i", "j"]}, "join_date": "2014/05/01"}\n'
    )
    r = load_documents(spark, str(tmp_path / "p.json"), PERSON, PERSON_DATE_FORMAT).first()
    assert (r["info"]["age"], r["info"]["interests"], r["join_date"]) == (30, ["i", "j"], date(2014, 5, 1))


SCHEMA = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])


def messages(spark, values):
    return spark.createDataFrame([("t", v) for v in values], "topic string, value string")


def test_undecodable_messages(spark):
    values = ['{"a": 1, "b": "x"}', "not json", None, "", '{"a": "text"}', "7", '{"b": null}', '{"a": 1']
    df = messages(spark, values)
    good, bad = decode_or_quarantine(df, SCHEMA)
    assert sorted((r["a"] or 0, r["b"] or "") for r in good.collect()) == [(0, ""), (1, "x")]
    assert {r["value"] for r in bad.collect()} == {values[i] for i in (1, 2, 3, 4, 5, 7)}
    texts = decode_or_text(df, SCHEMA)
    assert texts.count() == len(values)
    assert texts.filter("raw_text = '7'").select("a", "b").first() == (None, None)
    plain = decode_json(df, SCHEMA)
    assert plain.columns == ["topic", "a", "b"] and plain.count() == len(values)


def test_json_round_trip_keeps_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, "é\"\n")], SCHEMA)
    text = to_json_record(df)
    assert text.first()["value"] == '{"a":1,"b":null}'
    assert decode_json(text, SCHEMA).collect() == df.collect()


def test_delimited(spark):
    for sep in (",", ";", "|"):
        values = [sep.join("abcd"), sep.join("abcde"), sep.join("abc"), sep.join(["", "", "", ""])]
        got = decode_delimited(messages(spark, values), sep, ENRICHED_FIELDS).select(*ENRICHED_FIELDS).collect()
        assert [tuple(r) for r in got] == [tuple("abcd"), tuple("abcd"), ("", "", "", "")]


def test_topic_folders_read_only_what_is_subscribed(spark, tmp_path):
    for form in ("parquet", "json"):
        folder = Topics(form, str(tmp_path / form))
        df = spark.createDataFrame([("x", 1), ("y", 2), ("z", 3)], "topic string, n int")
        write_topics(to_messages(df, F.col("topic"), F.col("n").cast("string")), folder)
        two = read_topics(spark, folder, ["x", "z"])
        assert sorted((r["topic"], r["value"]) for r in two.collect()) == [("x", "1"), ("z", "3")]
        assert "PartitionFilters: [isnotnull(topic" in plan(two) or "PartitionFilters: [topic" in plan(two)
        assert [r["value"] for r in read_topic(spark, folder, "y").collect()] == ["2"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_two_layouts_in_one_folder(spark, tmp_path):
    (tmp_path / "a.csv").write_text('vendor_id,pickup_latitude,"a, quoted name"\nVTS,40.5,"x, y"\nCMT,40.6,z\n')
    (tmp_path / "b.csv").write_text("pickup_latitude,VendorID\n41.5,2\n41.6,1,too many\n41.7\n")
    rows = read_trips_csv(spark, str(tmp_path)).select("vendor_id", "pickup_latitude").collect()
    assert sorted(map(tuple, rows), key=repr) == [("2", 41.5), ("CMT", 40.6), ("VTS", 40.5), (None, 41.7)]


def test_lenient_decoding_nulls_only_the_field(spark):
    from curbflow.sources.topics import decode_lenient

    schema = T.StructType([T.StructField("VendorID", T.DoubleType()), T.StructField("lat", T.DoubleType())])
    texts = ['{"VendorID":"VTS","lat":"40.5"}', '{"vendor_id":2,"lat":1}', "[1]", "no json", '{"lat":{"a":1}}', None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string")
    got = {r["i"]: tuple(r)[1:] for r in decode_lenient(df, schema, {"VendorID": ("vendor_id",)}).collect()}
    assert got[0] == ("good", None, 40.5, None) and got[1] == ("good", 2.0, 1.0, None)
    assert got[3] == ("bad", None, None, "no json") and got[4][:3] == ("good", None, None)
    assert got[5][0] == "bad"
