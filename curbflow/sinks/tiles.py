"""A stored tile pyramid that batches and streams add to and take from.

A commit writes the cells of its own rows into a folder, split by precision; reading adds up the
folders, ``compact`` folds them into one. A batch that is run again changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from curbflow.operators.tiles import add_up, held, pyramid
from curbflow.sinks import folders
from curbflow.sinks.streams import DEFAULT_INTERVAL, start_batches


def _save(cells: DataFrame) -> Callable[[str], dict]:
    def write(folder: str) -> dict:
        # one task for each level, more where a level is large
        cells.hint("rebalance", F.col("precision")).write.partitionBy("precision").parquet(folder)
        return {}

    return write


def add_rows(
    spark: SparkSession,
    path: str,
    df: DataFrame,
    values: list[str] = (),
    precisions: list[int] = range(1, 8),
    lat: str = "lat",
    lon: str = "lon",
    sign: Column | None = None,
    batch: tuple[str, int] | None = None,
) -> bool:
    """Adds rows to the pyramid, or takes those away that have sign -1; False if known already."""
    if df.isEmpty():
        return False
    return folders.add(spark, path, _save(pyramid(df, values, precisions, lat, lon, sign)), batch)


def _cells(spark: SparkSession, path: str, entries: list[dict]) -> DataFrame:
    """The cells of some folders; all have the schema of the first one."""
    first, *rest = folders.paths(path, entries)
    kept = spark.read.parquet(first)
    for p in rest:
        kept = kept.unionByName(spark.read.schema(kept.schema).parquet(p))
    return kept


def read_tiles(spark: SparkSession, path: str, precisions: list[int] | None = None) -> DataFrame:
    """The cells of all or some levels; other levels' files are not read."""
    entries = folders.live(spark, path)
    if not entries:
        raise FileNotFoundError(f"nothing was committed at {path}")
    cells = _cells(spark, path, entries)
    wanted = cells if precisions is None else cells.filter(F.col("precision").isin(list(precisions)))
    return held(add_up(wanted) if len(entries) > 1 else wanted)


def compact(spark: SparkSession, path: str, above: int = 1) -> bool:
    """Adds up all folders into one where there are more than ``above``."""
    entries = folders.live(spark, path)
    return len(entries) > above and folders.fold(spark, path, entries, _save(add_up(_cells(spark, path, entries))))


def stream_tiles(
    df: DataFrame,
    path: str,
    checkpoint: str,
    values: list[str] = (),
    precisions: list[int] = range(1, 8),
    lat: str = "lat",
    lon: str = "lon",
    sign: Column | None = None,
    interval: str | None = DEFAULT_INTERVAL,
    above: int = 8,
) -> StreamingQuery:
    """Keeps a pyramid up with a stream, each batch once."""

    def step(batch: DataFrame, batch_id: int) -> None:
        add_rows(batch.sparkSession, path, batch, values, precisions, lat, lon, sign, (checkpoint, batch_id))
        compact(batch.sparkSession, path, above)

    return start_batches(df, step, checkpoint, interval)
