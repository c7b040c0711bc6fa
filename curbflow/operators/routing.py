"""Routing rows to topics and numbering documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from curbflow.session import reliable_checkpoint


def route_topic(
    df: DataFrame, topics: list[str], key: Column | None = None, seed: int | None = None
) -> DataFrame:
    """Adds the ``topic`` that each row goes to.

    With a key the route is a function of the row, so a retried task sends it to the same
    topic; without one the topic is drawn at random, as evenly.
    """
    names = F.array(*[F.lit(t) for t in topics])
    if key is None:
        slot = F.floor(F.rand(seed) * len(topics))
    else:
        slot = F.pmod(key, F.lit(len(topics)))
    return df.withColumn("topic", F.get(names, slot.cast("int")))


def with_doc_id(spark: SparkSession, df: DataFrame, order: list[str], id: str = "doc_id") -> DataFrame:
    """Numbers the rows 1, 2, ... in the given order, without sorting them in one task.

    A range sort spreads the rows; the sorted rows are checkpointed, so a lost executor
    cannot change their places; one count per partition gives each its offset. ``order``
    must tell all rows apart, which also keeps the sorted ranges even.
    """
    place = F.monotonically_increasing_id()
    placed = reliable_checkpoint(spark, df.sort(*order).withColumn("_place", place))
    part = F.shiftright("_place", 33)
    counts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    # one row per sort partition, so the window and the broadcast stay small
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    numbered = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    within = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return numbered.select(*df.columns, (F.col("_offset") + within + 1).alias(id))


def with_hash_id(df: DataFrame, columns: list[str], id: str = "doc_id") -> DataFrame:
    """A stable document id from the row itself: the same row has the same id on a rerun."""
    return df.withColumn(id, F.sha2(F.to_json(F.struct(*columns)), 256))
