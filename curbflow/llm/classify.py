"""What the two text classifiers share: the labelled training rows and the held-out rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: At most so many labelled documents are used to fit a model, the same ones at every run.
TRAINING_ROWS = 20_000


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the documents whose labels no model may learn from."""
    return F.expr(f"crc32(CAST(CAST({doc_id} AS STRING) AS BINARY)) % 4 = 2")


def training_rows(docs: DataFrame, labels: DataFrame, label: str, limit: int = TRAINING_ROWS) -> DataFrame:
    """(text, label) of a bounded sample of labelled documents, without any held-out one.

    Ids with a null label or with contradicting labels teach nothing. Sampled by the hash of the id.
    """
    known = (
        labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id").agg(F.min(label).alias("low"), F.max(label).alias("high"))
        .where("low = high")
        .select("doc_id", F.col("low").cast("int").alias("label"))
    )
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id").select("text", "label")
