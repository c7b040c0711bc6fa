"""The one place where streaming queries start."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

# Fixed value: the micro-batch interval of the active jobs.
DEFAULT_INTERVAL = "5 seconds"


def start(
    df: DataFrame,
    format: str,
    checkpoint: str | None = None,
    path: str | None = None,
    interval: str | None = DEFAULT_INTERVAL,
    partition_by: list[str] = (),
    mode: str = "append",
    **options: str,
) -> StreamingQuery:
    """Starts a stream; ``interval=None`` takes what is available now and stops.

    ``format="console"`` previews the first rows of each batch. File and Kafka sinks need a
    checkpoint folder that survives the loss of any machine.
    """
    writer = df.writeStream.format(format).outputMode(mode).options(**options)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if interval is None:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=interval)
    return writer.start(path) if path else writer.start()


def start_batches(
    df: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str, interval: str | None = DEFAULT_INTERVAL
) -> StreamingQuery:
    """Starts a stream that hands each micro-batch and its number to ``step``."""
    writer = df.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if interval is None else writer.trigger(processingTime=interval)).start()
