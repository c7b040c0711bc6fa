"""Points stored along a space-filling curve, so that a box or circle reads only the files near it.

The bits of a point's row and column of geohash cells, taken in turns, make its key: places that are
near each other mostly have near keys. Rows lie in one directory for each coarse cell, sorted by key;
the manifest names the cells of each commit. A box becomes ranges of keys by splitting the integer
rectangle of its cells; only directories that a range meets are listed, the ranges go to the scan, and
the exact test of the place follows. The key of a coordinate never falls where the coordinate rises, so
the cells of the corners bound those of all points between them.

Defined results: points without a key (null, not finite, beyond the poles, or beyond the date line)
lie in a directory of their own, which every search reads. An empty batch commits nothing.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbflow.functions.geo import axis_bits, circle_box, geohash_cell, in_bounding_box, within_distance
from curbflow.sinks import folders
from curbflow.sinks.manifests import names

FINE, COARSE = 8, 4
#: A box is split no further beyond this number of ranges; the exact test makes up for it.
RANGES = 32
ELSEWHERE = -1
_KEY, _CELL = "_key", "_cell"

Range = tuple[int, int]


def _spread(bits: Column) -> Column:
    """The low 32 bits of an integer, moved to places 0, 2, 4, ..."""
    for shift, mask in (
        (16, 0x0000FFFF0000FFFF),
        (8, 0x00FF00FF00FF00FF),
        (4, 0x0F0F0F0F0F0F0F0F),
        (2, 0x3333333333333333),
        (1, 0x5555555555555555),
    ):
        bits = bits.bitwiseOR(F.shiftleft(bits, shift)).bitwiseAND(F.lit(mask))
    return bits


def with_key(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """Adds the key at the fine precision, where rows and columns have the same number of bits."""
    row, column = geohash_cell(lat, lon, FINE)
    cells = df.withColumn("_row", row.cast("long")).withColumn("_column", column.cast("long"))
    key = _spread(F.col("_row")).bitwiseOR(F.shiftleft(_spread(F.col("_column")), 1))
    inside = (F.col(lon) >= -180) & (F.col(lon) < 180)
    return cells.withColumn(_KEY, F.when(inside, key)).drop("_row", "_column")


def _cell_bits() -> int:
    return 5 * (FINE - COARSE)


def _merged(ranges: list[Range]) -> list[Range]:
    out: list[Range] = []
    for low, high in sorted(ranges):
        if out and low <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def rectangle_ranges(rows: Range, columns: Range, bits: int, limit: int = RANGES) -> list[Range]:
    """Ranges of keys that cover a rectangle of cells, ``bits`` on each axis, largest squares first.

    Without a limit in the way they hold exactly the rectangle's cells, else some more.
    """
    whole: list[Range] = []
    # (first key, first row, first column, bits of the square's side)
    partial = [(0, 0, 0, bits)]
    while partial and len(whole) + len(partial) < limit:
        split = []
        for key, r, c, side in partial:
            if rows[0] <= r and r + (1 << side) - 1 <= rows[1] and columns[0] <= c and c + (1 << side) - 1 <= columns[1]:
                whole.append((key, key + (1 << 2 * side) - 1))
                continue
            half = side - 1
            for k in range(4):
                row, column = r + ((k & 1) << half), c + ((k >> 1) << half)
                if row <= rows[1] and row + (1 << half) > rows[0] and column <= columns[1] and column + (1 << half) > columns[0]:
                    split.append((key + (k << 2 * half), row, column, half))
        partial = split
    return _merged(whole + [(key, key + (1 << 2 * side) - 1) for key, _, _, side in partial])


def box_ranges(south: float, north: float, west: float, east: float, limit: int = RANGES) -> list[Range]:
    """The key ranges of a box; with ``west`` above ``east`` it crosses the date line."""
    if west > east:
        return _merged(box_ranges(south, north, west, 180.0, limit) + box_ranges(south, north, -180.0, east, limit))
    south, north, west, east = max(south, -90.0), min(north, 90.0), max(west, -180.0), min(east, 180.0)
    if not (south <= north and west <= east):
        return []
    bits, _ = axis_bits(FINE)
    last = (1 << bits) - 1
    # the same steps as the columns take
    rows = tuple(min(math.floor((v + 90) / 180 * (1 << bits)), last) for v in (south, north))
    columns = tuple(min(math.floor((v + 180) / 360 * (1 << bits)), last) for v in (west, east))
    return rectangle_ranges(rows, columns, bits, limit)


def _save(df: DataFrame) -> folders.Write:
    """Writes rows that have a key."""

    def write(folder: str) -> dict | None:
        cell = F.coalesce(F.shiftright(_KEY, _cell_bits()), F.lit(ELSEWHERE))
        celled = df.withColumn(_CELL, cell).hint("rebalance", F.col(_CELL))
        celled.sortWithinPartitions(_CELL, _KEY).write.partitionBy(_CELL).parquet(folder)
        prefix = f"{_CELL}="
        cells = sorted(int(n.removeprefix(prefix)) for n in names(df.sparkSession, folder) if n.startswith(prefix))
        return {"cells": cells, "schema": df.schema.jsonValue()} if cells else None

    return write


def append_points(
    spark: SparkSession, path: str, df: DataFrame, lat: str = "lat", lon: str = "lon", batch: tuple[str, int] | None = None
) -> bool:
    """Commits rows with their places; False where nothing was to do."""
    return folders.add(spark, path, _save(with_key(df, lat, lon)), batch)


def _rows(spark: SparkSession, path: str, ranges: list[Range] | None) -> DataFrame:
    """The stored rows with keys in the ranges, and those without one; all rows for None."""
    entries = folders.live(spark, path)
    if not entries:
        raise FileNotFoundError(f"nothing was committed at {path}")
    schema = T.StructType.fromJson(entries[0]["schema"])
    shift = _cell_bits()
    lasts = [high >> shift for _, high in ranges or []]

    def met(cell: int) -> bool:
        if ranges is None or cell == ELSEWHERE:
            return True
        at = bisect_left(lasts, cell)
        return at < len(lasts) and ranges[at][0] >> shift <= cell

    paths = [f"{path}/{e['name']}/{_CELL}={c}" for e in entries for c in e["cells"] if met(c)]
    rows = spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
    if ranges is None:
        return rows
    return rows.filter(reduce(lambda a, b: a | b, [F.col(_KEY).between(*r) for r in ranges], F.col(_KEY).isNull()))


def read_points(spark: SparkSession, path: str) -> DataFrame:
    """All rows."""
    return _rows(spark, path, None).drop(_KEY)


def read_box(
    spark: SparkSession, path: str, top_left: tuple[float, float], bottom_right: tuple[float, float], lat: str = "lat", lon: str = "lon"
) -> DataFrame:
    """The rows in or on the edge of the box."""
    (north, west), (south, east) = top_left, bottom_right
    near = _rows(spark, path, box_ranges(south, north, west, east))
    return near.filter(in_bounding_box(lat, lon, top_left, bottom_right)).drop(_KEY)


def read_near(
    spark: SparkSession, path: str, centre: tuple[float, float], metres: float, lat: str = "lat", lon: str = "lon"
) -> DataFrame:
    """The rows at most ``metres`` from the centre, by the ranges of the box around the circle."""
    south, north, sides = circle_box(centre, metres)
    near = _rows(spark, path, box_ranges(south, north, *(sides or (-180.0, 180.0))))
    return near.filter(within_distance(lat, lon, centre, metres)).drop(_KEY)


def compact(spark: SparkSession, path: str, above: int = 1) -> bool:
    """Joins all folders into one where there are more than ``above``."""
    entries = folders.live(spark, path)
    return len(entries) > above and folders.fold(spark, path, entries, _save(_rows(spark, path, None)))
