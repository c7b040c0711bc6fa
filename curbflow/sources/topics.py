"""Message topics: subscribing to them and decoding their values."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbflow.schemas import MESSAGE

CORRUPT = "_corrupt"


@dataclass(frozen=True)
class Topics:
    """Where topics live: a ``kafka`` cluster or a folder with one sub-folder per topic.

    ``Topics("kafka", options={"kafka.bootstrap.servers": ...})`` needs the Kafka package on
    the classpath. ``Topics("parquet", path)`` and ``Topics("json", path)`` keep messages in
    ``path/topic=<name>/``, so a subscription reads only the folders of its topics.
    """

    format: str
    path: str | None = None
    options: dict[str, str] = field(default_factory=dict)

    @property
    def is_broker(self) -> bool:
        return self.path is None


def read_topics(
    spark: SparkSession, source: Topics, topics: list[str], streaming: bool = False
) -> DataFrame:
    """Messages ``(key, value, topic)`` of the given topics, as text."""
    reader = (spark.readStream if streaming else spark.read).format(source.format)
    reader = reader.options(**source.options)
    if source.is_broker:
        loaded = reader.option("subscribe", ",".join(topics)).load()
        return loaded.selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value", "topic")
    return reader.schema(MESSAGE).load(source.path).filter(F.col("topic").isin(topics))


def read_topic(spark: SparkSession, source: Topics, topic: str, streaming: bool = False) -> DataFrame:
    """The values of one topic."""
    return read_topics(spark, source, [topic], streaming).select("value")


def decode_json(df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Replaces the JSON text by the declared fields; undecodable values give nulls."""
    rest = [F.col(c) for c in df.columns if c != value]
    parsed = df.select(*rest, F.from_json(value, schema).alias("_record"))
    return parsed.select(*rest, "_record.*")


def _parsed(df: DataFrame, schema: T.StructType, value: str) -> DataFrame:
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    record = F.from_json(
        value, with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
    parsed = df.withColumn("_record", record)
    bad = F.col("_record").isNull() | F.col(f"_record.{CORRUPT}").isNotNull()
    return parsed.withColumn("_bad", bad)


def decode_or_quarantine(
    df: DataFrame, schema: T.StructType, value: str = "value"
) -> tuple[DataFrame, DataFrame]:
    """(decoded rows, messages that are no JSON object of this schema)."""
    parsed = _parsed(df, schema, value)
    rest = [F.col(c) for c in df.columns if c != value]
    fields = [F.col(f"_record.{f.name}") for f in schema.fields]
    good = parsed.filter(~F.col("_bad")).select(*rest, *fields)
    bad = parsed.filter("_bad").select(*df.columns)
    return good, bad


def decode_tagged(df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Every message once: ``status`` good with its fields, or bad with its text."""
    rest = [F.col(c) for c in df.columns if c != value]
    bad = F.col("_bad")
    fields = [F.when(~bad, F.col(f"_record.{f.name}")).alias(f.name) for f in schema.fields]
    status = F.when(bad, "bad").otherwise("good").alias("status")
    return _parsed(df, schema, value).select(*rest, status, *fields, F.when(bad, F.col(value)).alias(value))


def decode_lenient(
    df: DataFrame,
    schema: T.StructType,
    aliases: dict[str, tuple[str, ...]] | None = None,
    value: str = "value",
) -> DataFrame:
    """Every message once, field by field: ``status``, the declared fields, and the text of bad ones.

    A value that does not fit its field, such as a name where a number is due, makes that field
    null and not the message bad; numbers may come as text. A field is found under its own name
    or an alias. Bad are only values that are no JSON object.
    """
    aliases = aliases or {}
    names = {f.name: (f.name, *aliases.get(f.name, ())) for f in schema.fields}
    texts = T.StructType([T.StructField(n, T.StringType()) for many in names.values() for n in many])
    parsed = _parsed(df, texts, value)
    rest = [F.col(c) for c in df.columns if c != value]
    bad = F.col("_bad")

    def field(f: T.StructField) -> Column:
        text = F.coalesce(*[F.col(f"_record.{n}") for n in names[f.name]])
        return F.when(~bad, text.try_cast(f.dataType)).alias(f.name)

    status = F.when(bad, "bad").otherwise("good").alias("status")
    return parsed.select(*rest, status, *map(field, schema.fields), F.when(bad, F.col(value)).alias(value))


def decode_or_text(df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Decoded fields for every message; ``raw_text`` keeps the text of undecodable ones."""
    rest = [F.col(c) for c in df.columns if c != value]
    fields = [F.when(~F.col("_bad"), F.col(f"_record.{f.name}")).alias(f.name) for f in schema.fields]
    raw = F.when(F.col("_bad"), F.col(value)).alias("raw_text")
    return _parsed(df, schema, value).select(*rest, *fields, raw)


def decode_delimited(
    df: DataFrame, sep: str, fields: list[str], value: str = "value"
) -> DataFrame:
    """The leading fields of delimited text, all as text; shorter records are left out."""
    rest = [F.col(c) for c in df.columns if c != value]
    parts = df.select(*rest, F.split(value, re.escape(sep)).alias("_parts"))
    named = [F.get("_parts", i).alias(name) for i, name in enumerate(fields)]
    return parts.filter(F.size("_parts") >= len(fields)).select(*rest, *named)
