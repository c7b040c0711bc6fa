"""Folder logs and what is kept in them: tiles, numbers, archives, against dictionaries."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from curbflow.functions import geo
from curbflow.operators import metrics
from curbflow.operators import tiles as pyramids
from curbflow.sinks import archive, folders, manifests, numbering, tiles

PLACES = "lat double, lon double, x double, sign int"


def points(spark, rows):
    return spark.createDataFrame(rows, PLACES)


def cells(df):
    return {(r["precision"], r["geohash"]): (r["n"], None if r["avg_x"] is None else round(r["avg_x"], 9)) for r in pyramids.with_geohash(df).collect()}


def grids(spark, rows):
    want = {}
    for p in range(1, 8):
        grid = metrics.geohash_grid(points(spark, rows), [F.count("*").alias("n"), F.avg("x").alias("avg_x")], p)
        want |= {(p, r["geohash"]): (r["n"], None if r["avg_x"] is None else round(r["avg_x"], 9)) for r in grid.collect()}
    return want


def test_every_level_equals_its_grid_after_rows_came_and_went(spark, tmp_path):
    draw, path = random.Random(3), str(tmp_path / "tiles")
    edges = [(90.0, 180.0, 1.0, 1), (-90.0, -180.0, 2.0, 1), (0.0, 0.0, None, 1), (None, 1.0, 3.0, 1), (91.0, 0.0, 3.0, 1), (5.0, 540.0, 4.0, 1)]
    # a third of the rows lie in one place
    first = edges + [(draw.uniform(40, 41), draw.uniform(-74, -73), float(draw.randrange(9)), 1) for _ in range(200)] + [(40.5, -73.5, 1.0, 1)] * 100
    gone, new = first[10:60] + [first[2]], [(40.5, -73.5, 8.0, 1), (-33.0, 151.0, 2.0, 1)]
    assert tiles.add_rows(spark, path, points(spark, first), ["x"], sign=F.col("sign"), batch=("s", 0))
    away = [(a, b, x, -1) for a, b, x, _ in gone] + [(40.5, -73.5, 1.0, -1)]
    for _ in range(2):
        # the second time the batch is known
        tiles.add_rows(spark, path, points(spark, away + new), ["x"], sign=F.col("sign"), batch=("s", 1))
    kept = list(first)
    for r in gone + [(40.5, -73.5, 1.0, 1)]:
        kept.remove(r)
    want = grids(spark, kept + new)
    assert cells(tiles.read_tiles(spark, path)) == want
    assert tiles.compact(spark, path) and not tiles.compact(spark, path)
    assert cells(tiles.read_tiles(spark, path)) == want
    level = tiles.read_tiles(spark, path, [geo.precision_for_zoom(13)])
    assert cells(level) == {k: v for k, v in want.items() if k[0] == geo.precision_for_zoom(13)}
    assert "precision IN" in level._jdf.queryExecution().toString() or "PartitionFilters: [isnotnull(precision" in level._jdf.queryExecution().toString()
    assert not tiles.add_rows(spark, path, points(spark, []), ["x"])


def test_a_cell_of_as_many_arrivals_as_departures_keeps_its_new_sum(spark, tmp_path):
    path = str(tmp_path / "tiles")
    tiles.add_rows(spark, path, points(spark, [(1.0, 1.0, 2.0, 1)]), ["x"], sign=F.col("sign"))
    tiles.add_rows(spark, path, points(spark, [(1.0, 1.0, 2.0, -1), (1.0, 1.0, 7.0, 1)]), ["x"], sign=F.col("sign"))
    assert set(cells(tiles.read_tiles(spark, path)).values()) == {(1, 7.0)}


def test_a_stream_keeps_tiles_up(spark, tmp_path):
    arrived, path, checkpoint = (str(tmp_path / n) for n in ("arrived", "tiles", "checkpoint"))
    rows = [(float(i % 50), float(i), float(i), 1) for i in range(60)]
    points(spark, rows).repartition(6).write.parquet(arrived)
    stream = spark.readStream.schema(PLACES).option("maxFilesPerTrigger", 1).parquet(arrived)
    for _ in range(2):
        tiles.stream_tiles(stream, path, checkpoint, ["x"], interval=None, above=2).awaitTermination()
    assert cells(tiles.read_tiles(spark, path)) == grids(spark, rows)
    assert len(folders.live(spark, path)) <= 3


def numbers(spark, path):
    return sorted((r["doc_id"], r["k"]) for r in numbering.read_numbered(spark, path).collect())


def test_numbers_have_no_gaps_or_repeats_over_failures_and_writers(spark, tmp_path, monkeypatch):
    path, arrived, checkpoint = (str(tmp_path / n) for n in ("numbers", "arrived", "checkpoint"))

    def run():
        stream = spark.readStream.schema("k long").parquet(arrived)
        numbering.stream_numbered(stream, path, checkpoint, ["k"], interval=None).awaitTermination()

    spark.range(0, 50).toDF("k").write.parquet(arrived)
    run()
    spark.range(100, 130).toDF("k").write.mode("append").parquet(arrived)
    publish = manifests.publish

    def lost(*_):
        raise OSError("the driver is gone")

    monkeypatch.setattr(manifests, "publish", lost)
    with pytest.raises(Exception, match="the driver is gone"):
        run()
    monkeypatch.setattr(manifests, "publish", publish)
    assert numbers(spark, path) == [(i + 1, i) for i in range(50)]
    run()
    run()
    want = [*range(50), *range(100, 130)]
    assert numbers(spark, path) == [(i + 1, k) for i, k in enumerate(want)]
    first = []

    def late(spark, path, state, version):
        # another writer takes the next numbers between this one's look and its commit
        if not first:
            first.append(version)
            numbering.append_numbered(spark, path, spark.range(300, 305).toDF("k"), ["k"])
        return publish(spark, path, state, version)

    monkeypatch.setattr(manifests, "publish", late)
    numbering.append_numbered(spark, path, spark.range(200, 203).toDF("k"), ["k"])
    want += [*range(300, 305), *range(200, 203)]
    assert numbers(spark, path) == [(i + 1, k) for i, k in enumerate(want)]
    assert not numbering.append_numbered(spark, path, spark.range(0).toDF("k"), ["k"])
    assert folders.vacuum(spark, path, keep=1, older_than=-60) > 0
    assert len(numbers(spark, path)) == len(want)


def test_an_archive_of_many_batches_ends_in_files_of_the_wanted_size(spark, tmp_path):
    path, wanted = str(tmp_path / "archive"), 2000
    lines = Counter()
    for b in range(24):
        rows = [(b + i / 10, -float(i), 0.0, 1) for i in range(20)] + [(None, 1.0, 0.0, 1)]
        df = points(spark, rows).coalesce(2)
        assert archive.append_archive(spark, path, df, batch=("s", b))
        assert not archive.append_archive(spark, path, df, batch=("s", b))
        lines.update(r["value"] for r in df.select(archive.archive_line("lat", "lon")).collect())
        before = folders.live(spark, path)
        archive.fold_archive(spark, path, wanted, above=7)
        # readers of the older manifest still find their folders
        assert all(spark.read.text(p).count() > 0 for p in folders.paths(path, before)[:1])
    assert Counter(r["value"] for r in archive.read_archive(spark, path).collect()) == lines
    assert archive.fold_archive(spark, path, wanted, above=0) >= 0
    sizes = defaultdict(int)
    read = spark.read.text(folders.paths(path, folders.live(spark, path)))
    for r in read.groupBy(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("s")).count().collect():
        sizes[r["f"]] = r["s"]
    # each file holds about as much as wanted
    assert len([s for s in sizes.values() if s < wanted / 2]) <= 1 and max(sizes.values()) <= 2.2 * wanted
    assert Counter(r["value"] for r in archive.read_archive(spark, path).collect()) == lines
    assert not archive.append_archive(spark, path, points(spark, []))
