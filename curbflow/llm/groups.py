"""Iterative and grouped helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.session import scratch_path


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` once to the shared folder and reads it back, which cuts its lineage."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """Smallest reachable id of every id in ``edges`` (columns a, b): rows (id, component_id).

    Rounds of large-star and small-star: every edge is turned towards the smallest neighbour
    until the edges are stars. A round costs four shuffles of the edges; the number of rounds
    grows with the logarithm of the longest chain. Ids without an edge are not returned.
    """
    now = stored(
        spark,
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "edges",
    )
    before = None
    while True:
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.where("v > u").join(least, "u").where("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.explode(F.expr("IF(v = m, array(struct(u, m AS v)), array(struct(v AS u, m AS v)))")).alias("e"))
            .select("e.u", "e.v").where("u <> v")
            .union(low.select("u", F.col("m").alias("v"))).distinct()
        )
        now = stored(spark, small, "edges")
        state = now.agg(F.count("*"), F.sum(F.expr("CAST(xxhash64(u, v) AS DECIMAL(38, 0))"))).first()
        if state == before:
            break
        before = state
    return now.select(F.col("u").alias("id"), F.col("v").alias("component_id")).union(
        now.select(F.col("v").alias("id"), F.col("v").alias("component_id"))
    ).distinct()


def block_pairs(members: DataFrame, key: str, own: str, block: int) -> DataFrame:
    """``members`` dealt out so that any two rows of a key meet in some ``group`` of bounded size.

    A key of more than ``block`` rows is cut into blocks by the hash of ``own``, and a group is a
    pair of blocks (or one block with itself). In a group of two blocks ``second`` tells them apart
    and only pairs across need a look; there are as many copies of a row as its key has blocks.
    """
    sizes = members.groupBy(key).agg(F.count("*").alias("_n")).where("_n > 1")
    placed = members.join(sizes, key).withColumn("_blocks", F.expr(f"CAST(ceil(_n / {block}) AS INT)"))
    placed = placed.withColumn("_own", F.pmod(F.xxhash64(own), F.col("_blocks")))
    other = F.explode(F.expr("IF(_blocks = 1, array(0), sequence(0, _blocks - 1))")).alias("_other")
    dealt = placed.select("*", other).withColumn("second", F.col("_own") > F.col("_other")).withColumn(
        "group", F.xxhash64(key, F.least("_own", "_other"), F.greatest("_own", "_other"))
    )
    return dealt.drop("_n", "_blocks", "_own", "_other").repartition("group").sortWithinPartitions("group")


def sides(second: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """The two sides to compare of the group in rows [low, high): its blocks, or one with itself."""
    rows = np.arange(low, high)
    return (rows[~second[low:high]], rows[second[low:high]]) if second[low:high].any() else (rows, rows)


def least_linked(ids: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least id that each row reaches over the links i - j."""
    label = ids.copy()
    while True:
        new = label.copy()
        np.minimum.at(new, i, label[j])
        np.minimum.at(new, j, label[i])
        if (new == label).all():
            return label
        label = new


def sorted_groups(batches: Iterator[pa.RecordBatch], key: str, work: Callable[[pa.Table], Iterator[pa.RecordBatch]]):
    """Calls ``work`` with the rows of whole key groups of a partition that is sorted by ``key``.

    Rows of the last key of a batch wait for the next batch. Several groups come at once.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        column = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(column, column[-1], side="left"))
        if cut:
            held.append(batch.slice(0, cut))
            yield from work(pa.Table.from_batches(held))
            held = [batch.slice(cut)]
        elif held and held[0].column(batch.schema.get_field_index(key))[0].as_py() != column[0]:
            yield from work(pa.Table.from_batches(held))
            held = [batch]
        else:
            held.append(batch)
    if held:
        yield from work(pa.Table.from_batches(held))
