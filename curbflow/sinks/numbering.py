"""Document numbers that go on from micro-batch to micro-batch, without gaps or repeats.

A batch is numbered 1, 2, ... within itself and written; the commit gives its folder the number of
rows that were committed before, and readers add that number. A batch that fails leaves no gap, one
that is run again changes nothing, and of two writers the second is moved up behind the first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from curbflow.operators.routing import with_doc_id
from curbflow.sinks import folders
from curbflow.sinks.streams import DEFAULT_INTERVAL, start_batches


def append_numbered(
    spark: SparkSession, path: str, df: DataFrame, order: list[str], id: str = "doc_id", batch: tuple[str, int] | None = None
) -> bool:
    """Commits rows under the next numbers, in the given order; False where nothing was to do."""

    def write(folder: str) -> dict | None:
        with_doc_id(spark, df, order, id).write.parquet(folder)
        # a count of Parquet rows reads the files' footers only
        rows = spark.read.parquet(folder).count()
        return {"rows": rows} if rows else None

    return folders.add(spark, path, write, batch)


def read_numbered(spark: SparkSession, path: str, id: str = "doc_id") -> DataFrame:
    """All committed rows with their numbers."""
    entries = folders.live(spark, path)
    if not entries:
        raise FileNotFoundError(f"nothing was committed at {path}")
    rows = spark.read.parquet(*folders.paths(path, entries))
    columns = rows.columns
    # one row for each commit
    firsts = spark.createDataFrame([(e["name"], e["first"]) for e in entries], "_folder string, _first long")
    named = rows.withColumn("_folder", F.regexp_extract("_metadata.file_path", "/(part-[0-9a-f]{32})/[^/]*$", 1))
    return named.join(firsts, "_folder").withColumn(id, F.col(id) + F.col("_first")).select(*columns)


def stream_numbered(
    df: DataFrame, path: str, checkpoint: str, order: list[str], id: str = "doc_id", interval: str | None = DEFAULT_INTERVAL
) -> StreamingQuery:
    """Numbers a stream of rows, each batch once."""

    def step(batch: DataFrame, batch_id: int) -> None:
        append_numbered(batch.sparkSession, path, batch, order, id, (checkpoint, batch_id))

    return start_batches(df, step, checkpoint, interval)
