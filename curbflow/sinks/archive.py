"""Archiving points as text files.

``stream_archive`` leaves the files of each micro-batch as they are. ``stream_folded_archive`` names
its folders in a manifest and joins small ones into files of the wanted size; readers take the
manifest's folders, so no line is ever hidden or doubled by the swap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from curbflow.sinks import folders
from curbflow.sinks.streams import DEFAULT_INTERVAL, start, start_batches


def archive_line(lat: str, lon: str) -> Column:
    """``[lat,lon]`` with 0 for a missing coordinate."""
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("0")) for c in (lat, lon)]
    return F.concat(F.lit("["), texts[0], F.lit(","), texts[1], F.lit("]")).alias("value")


def archive_points(
    df: DataFrame, path: str, lat: str = "lat", lon: str = "lon", max_records: int = 1_000_000
) -> None:
    """Appends points to a text archive, with at most ``max_records`` lines per file.

    Every point is written: there is no tail that waits for a file to fill.
    """
    df.select(archive_line(lat, lon)).write.mode("append").option("maxRecordsPerFile", max_records).text(path)


def stream_archive(
    df: DataFrame,
    path: str,
    checkpoint: str,
    lat: str = "lat",
    lon: str = "lon",
    max_records: int = 1_000_000,
    interval: str | None = DEFAULT_INTERVAL,
) -> StreamingQuery:
    """The same for a stream; each micro-batch closes its files."""
    return start(
        df.select(archive_line(lat, lon)),
        "text",
        checkpoint,
        path,
        interval,
        maxRecordsPerFile=str(max_records),
    )


def append_archive(
    spark: SparkSession, path: str, df: DataFrame, lat: str = "lat", lon: str = "lon", batch: tuple[str, int] | None = None
) -> bool:
    """Commits points as lines; False where nothing was to do."""

    def write(folder: str) -> dict | None:
        if df.isEmpty():
            return None
        df.select(archive_line(lat, lon)).write.text(folder)
        return {}

    return folders.add(spark, path, write, batch)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The committed lines as ``value``."""
    paths = folders.paths(path, folders.live(spark, path))
    return spark.read.text(paths) if paths else spark.createDataFrame([], "value string")


def fold_archive(spark: SparkSession, path: str, wanted_bytes: int = 128 << 20, above: int = 8) -> int:
    """Joins the folders below the wanted size where there are more than ``above``; their number.

    The new files hold from one to two times ``wanted_bytes``, or all there is where that is less.
    Lines keep no order, as in any archive that several tasks write.
    """
    small = [e for e in folders.live(spark, path) if e["bytes"] < wanted_bytes]
    if len(small) <= above:
        return 0
    files = max(1, sum(e["bytes"] for e in small) // wanted_bytes)

    def write(folder: str) -> dict:
        spark.read.text(folders.paths(path, small)).repartition(files).write.text(folder)
        return {}

    return len(small) if folders.fold(spark, path, small, write) else 0


def stream_folded_archive(
    df: DataFrame,
    path: str,
    checkpoint: str,
    lat: str = "lat",
    lon: str = "lon",
    wanted_bytes: int = 128 << 20,
    above: int = 8,
    interval: str | None = DEFAULT_INTERVAL,
) -> StreamingQuery:
    """Archives a stream of points, each batch once, and keeps the number of small folders down."""

    def step(batch: DataFrame, batch_id: int) -> None:
        append_archive(batch.sparkSession, path, batch, lat, lon, (checkpoint, batch_id))
        fold_archive(batch.sparkSession, path, wanted_bytes, above)

    return start_batches(df, step, checkpoint, interval)
