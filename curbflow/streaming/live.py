"""Training, assignment and ratios inside a running stream, scoped to its micro-batches.

Each micro-batch learns from its user points, starting from the model of the batch before, and
assigns its points by the new model; users, cars and their ratio are counted for each cluster of
the batch. The model is versioned state: a batch reads the latest version below its own number and
writes its own, so a batch that is run again after a failure gives the same rows in the same
folders. Only k rows reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from curbflow.operators.cluster import Centres, assign_clusters, train_batch
from curbflow.operators.metrics import supply_demand
from curbflow.sinks.streams import DEFAULT_INTERVAL, start_batches
from curbflow.streaming.jobs import USERS

_BATCH = "batch="


def _folder(path: str, table: str, batch_id: int) -> str:
    return f"{path}/{table}/{_BATCH}{batch_id}"


def versions(spark: SparkSession, path: str) -> list[int]:
    """The batch numbers whose models are complete, ascending."""
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/models")
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(root):
        return []
    done = lambda s: files.exists(spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))
    found = [(s.getPath().getName(), s) for s in files.listStatus(root)]
    return sorted(int(name.removeprefix(_BATCH)) for name, s in found if name.startswith(_BATCH) and done(s))


def model_before(spark: SparkSession, path: str, batch_id: int, start: Centres) -> Centres:
    """The model that the batch learns from."""
    earlier = [v for v in versions(spark, path) if v < batch_id]
    return Centres.from_rows(spark.read.parquet(_folder(path, "models", earlier[-1])).collect()) if earlier else start


def batch_step(path: str, start: Centres, decay: float, unit: str = "batches") -> Callable[[DataFrame, int], None]:
    """What a micro-batch does: ``models`` and ``ratios`` under ``path``, a folder for each batch."""

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        points = batch.select("topic", "lat", "lon").persist()
        try:
            before = model_before(spark, path, batch_id, start)
            model = train_batch(points.filter(F.col("topic") == USERS), before, decay, unit)
            ratios = supply_demand(assign_clusters(points, model))
            ratios.write.mode("overwrite").parquet(_folder(path, "ratios", batch_id))
            model.to_df(spark).write.mode("overwrite").parquet(_folder(path, "models", batch_id))
        finally:
            points.unpersist()

    return step


def stream_live_model(
    points: DataFrame, path: str, checkpoint: str, start: Centres, decay: float, interval: str | None = DEFAULT_INTERVAL, unit: str = "batches"
) -> StreamingQuery:
    """Starts the stream; ``interval=None`` takes what is available now and stops."""
    return start_batches(points, batch_step(path, start, decay, unit), checkpoint, interval)
