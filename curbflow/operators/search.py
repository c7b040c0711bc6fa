"""Searches over document frames."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from curbflow.functions import predicates


def search(
    df: DataFrame,
    predicate: Column | None = None,
    order: list[str] = (),
    size: int | None = None,
    fields: list[str] | None = None,
) -> DataFrame:
    """Documents that match, in order, the first ``size`` of them, only the chosen fields.

    With a size each task keeps its own best rows, so no full sort takes place. A size needs an
    order, else the rows would be arbitrary ones.
    """
    if size is not None and not order:
        raise ValueError("a size needs an order")
    hits = df.filter(predicates.match_all() if predicate is None else predicate)
    if order:
        hits = hits.orderBy(*order)
    if size is not None:
        hits = hits.limit(size)
    return hits.select(*fields) if fields else hits


def search_total(df: DataFrame, predicate: Column | None = None) -> DataFrame:
    """The number of matching documents."""
    return search(df, predicate).agg(F.count("*").alias("total"))


def get_by_ids(index: DataFrame, ids: list | DataFrame, id: str = "_id") -> DataFrame:
    """Documents with one of the ids, with the columns of the index.

    A list of any length becomes a table, which Spark broadcasts while it is small.
    """
    if not isinstance(ids, DataFrame):
        kind = to_arrow_type(index.schema[id].dataType)
        ids = index.sparkSession.createDataFrame(pa.table({id: pa.array(list(ids), kind)}))
    return index.join(ids.select(id), id, "left_semi").select(*index.columns)


def run_template(spark: SparkSession, text: str, args: dict) -> DataFrame:
    """A SQL text with named parameters."""
    return spark.sql(text, args=args)
