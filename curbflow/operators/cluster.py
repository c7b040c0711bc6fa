"""Online k-means: assignment, per-batch sums and the forgetful centre update."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import datetime, timedelta

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.functions.geo import has_numbers
from curbflow.operators.clean import timestamp_literal

POINT_COLUMNS = ("lat", "lon")

# The parameters of the active job.
DEFAULT_K = 8
DEFAULT_DIM = 2
DEFAULT_HALF_LIFE = 5.0

# When the lightest cluster counts as dying, and how far its revived centre moves.
DYING_RATIO = 1e-8
SPLIT_STEP = 1e-14


@dataclass(frozen=True)
class Centres:
    """A model: ``k`` centres and their weights. It is small and lives on the driver."""

    coords: tuple[tuple[float, ...], ...]
    weights: tuple[float, ...]

    def __post_init__(self):
        if len(self.coords) != len(self.weights) or not self.coords:
            raise ValueError("a model needs centres, each with a weight")

    @property
    def k(self) -> int:
        return len(self.coords)

    def rows(self) -> list[tuple]:
        return [(i, *map(float, c), float(w)) for i, (c, w) in enumerate(zip(self.coords, self.weights))]

    def to_df(self, spark: SparkSession, columns: tuple[str, ...] = POINT_COLUMNS) -> DataFrame:
        """``(cluster, <columns>, weight)``, one row per centre."""
        return spark.createDataFrame(_arrow_table(self.rows(), columns))

    @staticmethod
    def from_rows(rows, columns: tuple[str, ...] = POINT_COLUMNS) -> "Centres":
        ordered = sorted(rows, key=lambda r: r["cluster"])
        coords = tuple(tuple(float(r[c]) for c in columns) for r in ordered)
        return Centres(coords, tuple(float(r["weight"]) for r in ordered))


def _arrow_table(rows: list[tuple], columns: tuple[str, ...], batch: bool = False) -> pa.Table:
    """Model rows as an Arrow table: Spark then knows their true size when it plans a join."""
    types = {
        **({"batch": pa.string()} if batch else {}),
        "cluster": pa.int32(),
        **{c: pa.float64() for c in columns},
        "weight": pa.float64(),
    }
    values = list(zip(*rows)) or [()] * len(types)
    arrays = [pa.array(v, t) for v, t in zip(values, types.values())]
    return pa.table(dict(zip(types, arrays)))


def random_centres(
    k: int = DEFAULT_K, dim: int = DEFAULT_DIM, weight: float = 0.0, seed: int | None = None
) -> Centres:
    """Standard normal centres, all of one weight."""
    drawn = np.random.default_rng(seed).standard_normal((k, dim))
    return Centres(tuple(map(tuple, drawn.tolist())), (weight,) * k)


def given_centres(coords: list[tuple[float, ...]], weight: float = 0.0) -> Centres:
    return Centres(tuple(tuple(map(float, c)) for c in coords), (weight,) * len(coords))


def half_life_decay(half_life: float) -> float:
    """The decay per time unit after which ``half_life`` units leave half the weight."""
    return math.exp(math.log(0.5) / half_life)


def _squared_distance(columns: list[str], centre: list[str]) -> str:
    return " + ".join(f"({x} - {c}) * ({x} - {c})" for x, c in zip(columns, centre))


def _quoted(columns: tuple[str, ...]) -> list[str]:
    return [f"`{c}`" for c in columns]


# So many centres are compared in one projection, whose generated method stays small.
BLOCK_CENTRES = 32


def _with_nearest(points: DataFrame, columns: tuple[str, ...], centres: list[list[str]], name: str) -> DataFrame:
    """Adds the number of the nearest centre; centres are lists of SQL terms.

    Block by block: a projection holds the distances to a block of centres, the next takes their
    minimum, and a third keeps the better of it and the blocks before. Each is used more than once
    by the one above, so Spark leaves them apart, and every generated method stays small enough to
    be compiled at any number of centres.
    """
    names, out = _quoted(columns), points
    for start in range(0, len(centres), BLOCK_CENTRES):
        block = centres[start : start + BLOCK_CENTRES]
        distances = ", ".join(_squared_distance(names, c) for c in block)
        out = out.withColumn("_distances", F.expr(f"array({distances})")).withColumn("_least", F.array_min("_distances"))
        # the first position of the minimum, and earlier blocks: ties go to the lowest cluster
        number = F.expr(f"CAST(array_position(_distances, _least) + {start - 1} AS INT)")
        if start:
            better = F.col("_least") < F.col("_best")
            out = out.withColumns(
                {"_number": F.when(better, number).otherwise(F.col("_number")), "_best": F.least("_best", "_least")}
            )
        else:
            out = out.withColumns({"_number": number, "_best": F.col("_least")})
    return out.select(*[f"`{c}`" for c in points.columns if c != name], F.coalesce("_number", F.lit(0)).alias(name))


def _terms(centres: Centres) -> list[list[str]]:
    return [[f"({float(x)!r}D)" for x in c] for c in centres.coords]


# Beyond the box of all centres cells double in size, up to so many doublings of the box; what lies
# further out is one cell.
RINGS = 8
GROUP_CELLS = 8  # cells on a side that share a first choice of candidates
BROADCAST_BYTES = 64 << 20  # a larger table of cells is joined by shuffle


@dataclass(frozen=True)
class _Axis:
    """One coordinate cut into cells over the centres' range, and rings of doubling width outside."""

    low: float
    high: float
    cells: int

    @property
    def width(self) -> float:
        return (self.high - self.low) or 1.0

    @property
    def step(self) -> float:
        return self.width / self.cells

    @property
    def rings(self) -> int:
        return RINGS + math.ceil(math.log2(self.cells))

    @property
    def span(self) -> int:
        """Bounded cells."""
        return self.cells + 2 * self.rings

    @property
    def bounds(self) -> np.ndarray:
        """Least and greatest coordinate of each bounded cell, with room for rounding."""
        inner = self.low + self.step * np.arange(self.cells + 1)
        rings = self.step * (2.0 ** np.arange(1, self.rings + 1) - 1)
        edges = np.concatenate([self.low - rings[::-1], inner, max(self.high, inner[-1]) + rings])
        slack = 1e-9 * (np.abs(edges) + self.width)
        return np.stack([(edges - slack)[:-1], (edges + slack)[1:]], axis=1)

    def number(self, column: str) -> str:
        """SQL: the cell's number from 0; -1 and ``span`` are the unbounded ones."""
        ring = f"CAST(least(floor(log2(1 + ({{}}) / {self.step!r}D)), {self.rings}) AS INT)"
        below, above = ring.format(f"{self.low!r}D - {column}"), ring.format(f"{column} - {self.high!r}D")
        inner = f"CAST(least(floor(({column} - {self.low!r}D) / {self.step!r}D), {self.cells - 1}) AS INT)"
        return (
            f"CASE WHEN {column} < {self.low!r}D THEN {self.rings - 1} - {below} WHEN {column} > {self.high!r}D"
            f" THEN {self.rings + self.cells} + {above} ELSE {self.rings} + {inner} END"
        )


def _possible(coords: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Of each box (rows of low and high corners) which centres can be nearest to one of its points.

    A centre can't where another one is nearer to all four corners, as the points that are nearer
    to one of two centres form a half plane. The centres closest to the corners and to the middle
    are tried as the others. Where it is close, by rounding, a centre stays.
    """

    def squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return (coords[None, :, 0] - x[:, None]) ** 2 + (coords[None, :, 1] - y[:, None]) ** 2

    corners = [squares(x, y) for x in (low[:, 0], high[:, 0]) for y in (low[:, 1], high[:, 1])]
    middle = squares((low[:, 0] + high[:, 0]) / 2, (low[:, 1] + high[:, 1]) / 2)
    fit = np.ones(middle.shape, bool)
    for other in {tuple(d.argmin(1)) for d in (middle, *corners)}:
        own = [d[np.arange(len(low)), other][:, None] for d in corners]
        fit &= ~np.logical_and.reduce([o < d * (1 - 1e-9) for o, d in zip(own, corners)])
    return fit


def _cells(coords: np.ndarray) -> tuple[tuple[_Axis, _Axis], pa.Table]:
    """The axes, and a table (cell, candidates): every centre that can be nearest to a point of the cell."""
    side = math.ceil(2 * math.sqrt(len(coords)))
    axes = tuple(_Axis(float(v.min()), float(v.max()), side) for v in coords.T)
    across = [axis.bounds for axis in axes]
    span = axes[0].span
    keys, counts, found = [np.array([-1])], [np.array([len(coords)])], [np.arange(len(coords))]  # the unbounded cell
    for a in range(0, span, GROUP_CELLS):
        for b in range(0, span, GROUP_CELLS):
            x, y = across[0][a : a + GROUP_CELLS], across[1][b : b + GROUP_CELLS]
            (some,) = _possible(coords, np.array([[x[0, 0], y[0, 0]]]), np.array([[x[-1, 1], y[-1, 1]]]))
            some = np.flatnonzero(some)
            i, j = (v.ravel() for v in np.meshgrid(np.arange(len(x)), np.arange(len(y)), indexing="ij"))
            box = [np.stack([x[i, side_], y[j, side_]], axis=1) for side_ in (0, 1)]
            fit = _possible(coords[some], *box)
            keys.append((a + i) * span + b + j)
            counts.append(fit.sum(1))
            found.append(some[np.nonzero(fit)[1]])
    flat, keys = np.concatenate(found), np.concatenate(keys)
    at = np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype(np.int32)
    rows = pa.StructArray.from_arrays(
        [pa.array(flat.astype(np.int32)), pa.array(coords[flat, 0]), pa.array(coords[flat, 1])], names=["cluster", "x", "y"]
    )
    return axes, pa.table({"_cell": pa.array(keys, pa.int64()), "_candidates": pa.ListArray.from_arrays(pa.array(at), rows)})


def _with_nearest_by_cell(points: DataFrame, columns: tuple[str, ...], centres: Centres, name: str) -> DataFrame:
    """Adds the number of the nearest centre, found among the few that can be nearest in the point's cell.

    The cells are a grid over the box of all centres, with as many cells as there are centres, times
    four, so a point's work does not grow with their number. The join is on the integer cell.
    """
    (across, along), table = _cells(np.array(centres.coords, float))
    x, y = _quoted(columns)
    i, j, span = across.number(x), along.number(y), across.span
    cell = F.expr(f"transform(array(struct({i} AS i, {j} AS j)), c -> IF(least(c.i, c.j) < 0 OR greatest(c.i, c.j) >= {span}, -1L, CAST(c.i AS BIGINT) * {span} + c.j))[0]")
    cells = points.sparkSession.createDataFrame(table)
    placed = points.withColumn("_cell", F.coalesce(cell, F.lit(-1).cast("long")))
    joined = placed.join(F.broadcast(cells) if table.nbytes <= BROADCAST_BYTES else cells, "_cell")
    distance = _squared_distance([x, y], ["c.x", "c.y"])
    nearest = F.expr(f"array_min(transform(_candidates, c -> struct({distance} AS d, c.cluster AS cluster))).cluster")
    return joined.select(*[f"`{c}`" for c in points.columns if c != name], F.coalesce(nearest, F.lit(0)).alias(name))


def assign_clusters(
    points: DataFrame, centres: Centres, columns: tuple[str, ...] = POINT_COLUMNS
) -> DataFrame:
    """Adds ``cluster`` to the points that have coordinates; others are left out.

    Up to ``BLOCK_CENTRES`` centres, or in other than two dimensions, all distances stand in a
    projection, without a join; more centres are narrowed down by cells. No shuffle, in batch or stream.
    The column is declared free of nulls: else a later join or filter on it would push a null
    test below this projection, and with it a second copy of all distances.
    """
    placed = points.filter(has_numbers(list(columns)))
    if len(columns) == 2 and centres.k > BLOCK_CENTRES and np.isfinite(centres.coords).all():
        return _with_nearest_by_cell(placed, columns, centres, "cluster")
    return _with_nearest(placed, columns, _terms(centres), "cluster")


def cluster_sums(
    points: DataFrame, centres: Centres, columns: tuple[str, ...] = POINT_COLUMNS
) -> DataFrame:
    """``(cluster, n, sum_<column>...)`` of the points; at most k rows leave each task."""
    sums = [F.sum(c).alias(f"sum_{c}") for c in columns]
    assigned = assign_clusters(points.select(*columns), centres, columns)
    return assigned.groupBy("cluster").agg(F.count("*").alias("n"), *sums)


def update_centres(
    centres: Centres,
    sums: list,
    decay: float,
    unit: str = "batches",
    columns: tuple[str, ...] = POINT_COLUMNS,
) -> Centres:
    """One model update from at most k rows of ``cluster_sums``.

    Old weights fade by ``decay`` per batch, or per point with ``unit="points"``. Each centre
    moves to the weighted mean of its old place and its new points. A cluster whose weight
    vanished is revived beside the heaviest one, which shares its weight with it.
    """
    if unit not in ("batches", "points"):
        raise ValueError("unit is 'batches' or 'points'")
    coords = np.array(centres.coords, dtype=float)
    weights = np.array(centres.weights, dtype=float)
    new_points = np.zeros(centres.k)
    new_sums = np.zeros_like(coords)
    for row in sums:
        new_points[row["cluster"]] = row["n"]
        new_sums[row["cluster"]] = [row[f"sum_{c}"] for c in columns]
    faded = weights * (decay if unit == "batches" else decay ** new_points.sum())
    weights = faded + new_points
    hit = new_points > 0
    coords[hit] = (coords[hit] * faded[hit, None] + new_sums[hit]) / weights[hit, None]
    heavy, light = int(weights.argmax()), int(weights.argmin())
    if weights[light] < DYING_RATIO * weights[heavy]:
        weights[[heavy, light]] = (weights[heavy] + weights[light]) / 2
        step = SPLIT_STEP * np.maximum(np.abs(coords[heavy]), 1.0)
        coords[light] = coords[heavy] - step
        coords[heavy] = coords[heavy] + step
    return Centres(tuple(map(tuple, coords.tolist())), tuple(weights.tolist()))


def train_batch(
    points: DataFrame,
    centres: Centres,
    decay: float,
    unit: str = "batches",
    columns: tuple[str, ...] = POINT_COLUMNS,
) -> Centres:
    """One update with all the points as one batch."""
    sums = cluster_sums(points, centres, columns).collect()
    return update_centres(centres, sums, decay, unit, columns)


def window_start(ts: str, every: timedelta) -> Column:
    """Start of the tumbling window that holds ``ts``."""
    return F.window(ts, f"{int(every.total_seconds())} seconds")["start"]


def window_range(points: DataFrame, ts: str, every: timedelta) -> tuple[datetime, datetime] | None:
    """First and last window start of the points; one pass over ``ts`` alone."""
    edges = points.agg(F.min(ts).alias("first"), F.max(ts).alias("last"))
    moments = edges.select(F.explode(F.array("first", "last")).alias("at")).filter("at IS NOT NULL")
    starts = [r[0] for r in moments.select(window_start("at", every).cast("timestamp_ntz")).collect()]
    return (min(starts), max(starts)) if starts else None


def filled_windows(points: DataFrame, ts: str, every: timedelta) -> set[datetime]:
    """Starts of the windows that hold points, by one grouped pass over ``ts``."""
    starts = points.select(window_start(ts, every).cast("timestamp_ntz").alias("start")).distinct()
    return {r[0] for r in starts.collect()}


def train_windows(
    points: DataFrame,
    centres: Centres,
    every: timedelta,
    decay: float,
    unit: str = "batches",
    ts: str = "ts",
    columns: tuple[str, ...] = POINT_COLUMNS,
    bounds: tuple[datetime, datetime] | None = None,
    prune: Callable[[datetime, datetime], Column] | None = None,
) -> Iterator[tuple[datetime, Centres]]:
    """Folds the model over the tumbling windows of ``ts``, oldest first.

    Yields ``(window start, model after it)``. Windows without points fade the weights too, and
    cost no Spark job: one pass finds the windows that hold points.
    Each step reads only its own time range: the bounds are literals on ``ts`` that reach the
    scan, so keep stored points sorted on time, or partitioned by it with ``prune`` giving the
    filter on the partition column. k rows per step reach the driver and the new centres go
    into the next step as literals, so plans do not grow.
    """
    if bounds is not None:
        first = timestamp_literal(points, ts, bounds[0])
        span = (F.col(ts) >= first) & (F.col(ts) < timestamp_literal(points, ts, bounds[1] + every))
        known = points.filter(span if prune is None else prune(bounds[0], bounds[1] + every) & span)
    else:
        known = points.filter(F.col(ts).isNotNull())
    filled = filled_windows(known, ts, every)
    if bounds is None:
        if not filled:
            return
        bounds = min(filled), max(filled)
    start, last = bounds
    while start <= last:
        end = start + every
        if start not in filled:
            centres = update_centres(centres, [], decay, unit, columns)
            yield start, centres
            start = end
            continue
        inside = (F.col(ts) >= timestamp_literal(points, ts, start)) & (
            F.col(ts) < timestamp_literal(points, ts, end)
        )
        if prune is not None:
            inside = prune(start, end) & inside
        centres = train_batch(points.filter(inside), centres, decay, unit, columns)
        yield start, centres
        start = end


def history_df(
    spark: SparkSession,
    history: list[tuple[datetime, Centres]],
    columns: tuple[str, ...] = POINT_COLUMNS,
) -> DataFrame:
    """``(batch, cluster, <columns>, weight)``: k rows for each window."""
    rows = [(start.isoformat(), *row) for start, model in history for row in model.rows()]
    table = spark.createDataFrame(_arrow_table(rows, columns, batch=True))
    # through text: an Arrow timestamp would arrive in the session's time zone
    return table.withColumn("batch", F.col("batch").cast("timestamp_ntz"))


def assign_with_history(
    points: DataFrame,
    history: DataFrame,
    k: int,
    every: timedelta,
    ts: str = "ts",
    predict_first: bool = False,
    columns: tuple[str, ...] = POINT_COLUMNS,
    start: Centres | None = None,
) -> DataFrame:
    """Adds ``batch`` and ``cluster``, each window with its own model of ``k`` centres; no point is dropped for want
    of one.

    The default trains on a window and then assigns it; ``predict_first`` assigns it with the
    model of the window before. Windows before the first trained model take the ``start`` model
    (the first trained one if none is given), windows after the last one take the last. ``history`` holds every window from the first to the
    last, as ``train_windows`` yields them. The model table has one row per window with its
    centres as an array, so Spark broadcasts it while its size allows and else joins on the
    window, where adaptive execution splits a window that holds too many points.
    """
    spark, shift = points.sparkSession, int((every if predict_first else timedelta(0)).total_seconds())
    usable = history.withColumn("_model", F.col("batch") + F.expr(f"INTERVAL {shift} SECONDS"))
    edges = usable.agg(F.min("_model"), F.max("_model")).first()
    placed = points.filter(has_numbers(list(columns)) & F.col(ts).isNotNull()).withColumn(
        "batch", window_start(ts, every).cast("timestamp_ntz")
    )
    if edges[0] is None:
        if start is None:
            raise ValueError("without a trained model a start model is needed")
        return _with_nearest(placed, columns, _terms(start), "cluster")
    known, before = usable.select("_model", "cluster", *columns), edges[0]
    if start is not None:
        before = edges[0] - every
        moment = F.expr(f"TIMESTAMP_NTZ '{before:%Y-%m-%d %H:%M:%S.%f}'")
        known = known.union(start.to_df(spark, columns).select(moment, "cluster", *columns))
    models = known.groupBy("_model").agg(F.array_sort(F.collect_list(F.struct("cluster", *columns))).alias("_centres"))
    at = [F.expr(f"TIMESTAMP_NTZ '{t:%Y-%m-%d %H:%M:%S.%f}'") for t in (before, edges[1])]
    placed = placed.withColumn("_model", F.greatest(F.least(F.col("batch"), at[1]), at[0]))
    names = [[f"_centres[{i}].`{c}`" for c in columns] for i in range(k)]
    assigned = _with_nearest(placed.join(models, "_model"), columns, names, "cluster")
    return assigned.select(*points.columns, "batch", "cluster")
