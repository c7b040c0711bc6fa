"""A pyramid of map tiles: aggregates per geohash cell at all zoom levels, from one pass.

Cells are pairs of integers. A parent's pair is its children's shifted right, so rows are grouped once,
into the finest cells, and every coarser level adds up those. All columns are sums: pyramids of
different rows add up, and rows that went away count with sign -1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbflow.functions.geo import axis_bits, geohash_cell, geohash_text, has_numbers, precision_for_zoom

_KEY = ["precision", "row", "column"]


def _total(name: str) -> str:
    return f"{name}_sum"


def _count(name: str) -> str:
    return f"{name}_n"


def pyramid(
    df: DataFrame, values: list[str] = (), precisions: list[int] = range(1, 8), lat: str = "lat", lon: str = "lon", sign: Column | None = None
) -> DataFrame:
    """``precision, row, column, n`` and for each value its sum and how many have one.

    Rows without a place are left out. The second shuffle moves cells, not rows.
    """
    finest, sign = max(precisions), F.lit(1) if sign is None else sign
    row, column = geohash_cell(lat, lon, finest)
    sums = [F.sum(sign.cast("long")).alias("n")]
    for v in values:
        sums += [F.sum(F.col(v) * sign).alias(_total(v)), F.sum(F.when(F.col(v).isNotNull(), sign.cast("long")).otherwise(0)).alias(_count(v))]
    placed = df.filter(has_numbers([lat, lon]))
    cells = placed.groupBy(row.alias("row"), column.alias("column")).agg(*sums).filter(F.col("row").isNotNull())
    rows, columns = axis_bits(finest)
    levels = []
    for p in sorted(precisions):
        up, left = axis_bits(p)
        levels.append(F.struct(F.lit(p).alias("precision"), F.shiftright("row", rows - up).alias("row"), F.shiftright("column", columns - left).alias("column")))
    measures = [c for c in cells.columns if c not in ("row", "column")]
    return add_up(cells.select(F.inline(F.array(*levels)), *measures))


def add_up(cells: DataFrame) -> DataFrame:
    """Cells of several pyramids, added up. A cell where as many rows came as went stays: its sums may
    have changed, and the rows that went may lie in another pyramid."""
    return cells.groupBy(*_KEY).agg(*[F.sum(c).alias(c) for c in cells.columns if c not in _KEY])


def held(cells: DataFrame) -> DataFrame:
    """The cells that rows are left in, once all pyramids are added up."""
    return cells.filter("n <> 0")


def with_geohash(cells: DataFrame) -> DataFrame:
    """``precision, geohash, n`` and the sum and mean of each value, null where no row has one."""
    # a cell's first descendant among the finest cells has the cell's letters first
    down = cells.withColumn("_row", F.expr("shiftleft(row, CAST(30 - 5 * precision div 2 AS INT))")).withColumn(
        "_column", F.expr("shiftleft(column, CAST(30 - (5 * precision - 5 * precision div 2) AS INT))")
    )
    text = F.substr(geohash_text("_row", "_column", 12), F.lit(1), F.col("precision"))
    named = [c.removesuffix("_sum") for c in cells.columns if c.endswith("_sum")]
    some = {v: F.col(_count(v)) != 0 for v in named}
    sums = [F.when(some[v], F.col(_total(v))).alias(f"sum_{v}") for v in named]
    means = [F.when(some[v], F.col(_total(v)) / F.col(_count(v))).alias(f"avg_{v}") for v in named]
    return down.select("precision", text.alias("geohash"), "n", *sums, *means)


def at_zoom(cells: DataFrame, zoom: int, finest: int = 7) -> DataFrame:
    """The level that a map of this zoom shows."""
    return cells.filter(F.col("precision") == precision_for_zoom(zoom, finest))
