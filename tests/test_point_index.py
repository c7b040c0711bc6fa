"""Stored points: key ranges against all cells, searches against a scan, and the files read."""

import random
import re

import pytest
from pyspark.sql import functions as F

from curbflow.functions import geo
from curbflow.sinks import folders, point_index

SCHEMA = "id long, lat double, lon double"
BOXES = [((40.8, -74.0), (40.7, -73.0)), ((90.0, 170.0), (-90.0, -170.0)), ((0.0, 0.0), (0.0, 0.0)), ((91.0, -200.0), (-91.0, 200.0)), ((10.0, 5.0), (20.0, 6.0))]
CIRCLES = [((40.75, -73.98), 16000.0), ((89.9, 10.0), 50000.0), ((0.0, 179.99), 5000.0), ((40.75, -73.98), 0.0)]


def key(row, column, bits):
    return sum((row >> b & 1) << 2 * b | (column >> b & 1) << 2 * b + 1 for b in range(bits))


@pytest.mark.parametrize("seed", range(20))
def test_ranges_hold_the_rectangle_and_nothing_else(seed):
    draw, bits = random.Random(seed), 4
    rows, columns = (tuple(sorted(draw.choices(range(16), k=2))) for _ in range(2))
    want = {key(r, c, bits) for r in range(rows[0], rows[1] + 1) for c in range(columns[0], columns[1] + 1)}

    def held(limit):
        ranges = point_index.rectangle_ranges(rows, columns, bits, limit)
        assert ranges == sorted(ranges) and len(ranges) <= limit + 3 * limit
        return {k for low, high in ranges for k in range(low, high + 1)}

    assert held(1000) == want
    assert held(4) >= want


def points():
    draw = random.Random(4)
    odd = [None, float("nan"), float("inf"), 90.0, -90.0, 180.0, -180.0, 179.995, 0.0, 200.0, -0.0, 89.95]
    rows = [(a, b) for a in odd for b in odd]
    rows += [(draw.uniform(40, 41), draw.uniform(-74.5, -72.5)) for _ in range(400)] + [(40.75, -73.98)] * 200
    rows += [(draw.uniform(-90, 90), draw.uniform(-180, 180)) for _ in range(200)]
    return [(i, *r) for i, r in enumerate(rows)]


def test_searches_equal_a_scan_before_and_after_compaction(spark, tmp_path):
    path, rows = str(tmp_path / "points"), points()
    df = spark.createDataFrame(rows, SCHEMA)
    for i in range(2):
        assert point_index.append_points(spark, path, df.filter(F.col("id") % 2 == i), batch=("s", i))
        assert not point_index.append_points(spark, path, df, batch=("s", i))
    assert not point_index.append_points(spark, path, df.limit(0))
    ids = lambda found: sorted(r["id"] for r in found.select("id").collect())
    for _ in range(2):
        assert ids(point_index.read_points(spark, path)) == [r[0] for r in rows]
        for box in BOXES:
            assert ids(point_index.read_box(spark, path, *box)) == ids(df.filter(geo.in_bounding_box("lat", "lon", *box)))
        for circle in CIRCLES:
            assert ids(point_index.read_near(spark, path, *circle)) == ids(df.filter(geo.within_distance("lat", "lon", *circle)))
        point_index.compact(spark, path)
    assert len(folders.live(spark, path)) == 1


def test_only_files_near_the_box_are_read(spark, tmp_path):
    path = str(tmp_path / "points")
    grid = [(i, -80.0 + 160 * (i % 20) / 20, -170.0 + 340 * (i // 20) / 20) for i in range(400)]
    point_index.append_points(spark, path, spark.createDataFrame(grid, SCHEMA))
    near = point_index.read_box(spark, path, (1.0, -1.0), (-1.0, 1.0))
    stored = {c for e in folders.live(spark, path) for c in e["cells"]}
    read = {int(re.search(r"_cell=(-?\d+)/", f).group(1)) for f in near.inputFiles()}
    assert len(stored) > 300 and len(read) <= 4
    assert near.count() == 1
    assert "GreaterThanOrEqual(_key" in near._jdf.queryExecution().executedPlan().toString()
