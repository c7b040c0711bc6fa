"""Publishing rows as topic messages, straight from the executors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from curbflow.sinks.streams import DEFAULT_INTERVAL, start
from curbflow.sources.topics import Topics


def json_record(columns: list[str]) -> Column:
    """One JSON object of the columns; nulls stay in it as ``null``."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def to_json_record(df: DataFrame, name: str = "value") -> DataFrame:
    """Each row as one JSON object."""
    return df.select(json_record(df.columns).alias(name))


def delimited(columns: list[str], sep: str = ",") -> Column:
    """The columns as text, joined; a null makes an empty field so that positions hold."""
    return F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])


def to_messages(
    df: DataFrame,
    topic: str | Column,
    value: Column,
    key: Column | None = None,
    partition: Column | None = None,
) -> DataFrame:
    """Messages ``(key, value, topic[, partition])`` ready for ``write_topics``."""
    columns = [
        (F.lit(None) if key is None else key).cast("string").alias("key"),
        value.cast("string").alias("value"),
        (F.lit(topic) if isinstance(topic, str) else topic).alias("topic"),
    ]
    if partition is not None:
        columns.append(partition.cast("int").alias("partition"))
    return df.select(*columns)


def write_topics(messages: DataFrame, target: Topics) -> None:
    """Appends a batch of messages."""
    writer = messages.write.format(target.format).options(**target.options)
    if target.is_broker:
        writer.save()
    else:
        writer.mode("append").partitionBy(*_folders(messages)).save(target.path)


def _folders(messages: DataFrame) -> list[str]:
    return [c for c in ("topic", "partition") if c in messages.columns]


def stream_topics(
    messages: DataFrame, target: Topics, checkpoint: str, interval: str | None = DEFAULT_INTERVAL
) -> StreamingQuery:
    """Publishes a stream of messages."""
    if target.is_broker:
        return start(messages, target.format, checkpoint, interval=interval, **target.options)
    return start(
        messages, target.format, checkpoint, target.path, interval, _folders(messages), **target.options
    )
