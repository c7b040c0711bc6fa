"""Typed document indices kept as Parquet tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from curbflow.functions.geo import parse_geo_point
from curbflow.schemas import Field, mapping_type
from curbflow.session import scratch_path
from curbflow.sinks.streams import DEFAULT_INTERVAL, start


def _mapped(df: DataFrame, f: Field) -> Column:
    if f.name not in df.columns:
        declared = mapping_type([f]).fields[0].dataType
        return F.lit(None).cast(declared)
    given = df.schema[f.name].dataType
    column = F.col(f.name)
    if f.type == "geo_point":
        if isinstance(given, T.StringType):
            return parse_geo_point(column)
        lat, lon = (column[c].try_cast("double") for c in ("lat", "lon"))
        return F.when(column.isNotNull(), F.struct(lat.alias("lat"), lon.alias("lon")))
    if f.type == "date":
        if isinstance(given, T.StringType):
            return F.try_to_timestamp(column, F.lit(f.format)).cast("timestamp_ntz")
        return column.cast("timestamp_ntz")
    return column.try_cast(f.type)


def apply_mapping(df: DataFrame, mapping: list[Field]) -> DataFrame:
    """The mapped fields with their declared types; values that do not fit become null."""
    return df.select(*[_mapped(df, f).alias(f.name) for f in mapping])


def create_index(spark: SparkSession, name: str, mapping: list[Field], path: str | None = None) -> None:
    """Creates the typed index once; an index of that name stays as it is."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in mapping_type(mapping).fields)
    location = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{location}")


def drop_index(spark: SparkSession, name: str) -> None:
    """Drops the index; a missing one is ignored."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def list_indices(spark: SparkSession, database: str = "default") -> list[str]:
    return [t.name for t in spark.catalog.listTables(database) if not t.isTemporary]


def index_counts(indices: dict[str, DataFrame]) -> DataFrame:
    """``(index, docs)``: one document count per index."""
    counts = [
        docs.agg(F.count("*").alias("docs")).select(F.lit(name).alias("index"), "docs")
        for name, docs in indices.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def counts_by(df: DataFrame, name: str) -> DataFrame:
    """``(index, docs)`` of several indices that are kept in one table, in one pass."""
    return df.groupBy(F.col(name).alias("index")).agg(F.count("*").alias("docs"))


def append_index(df: DataFrame, path: str) -> None:
    """Appends documents without an id: writing the same batch again doubles it."""
    df.write.mode("append").parquet(path)


def stream_index(
    df: DataFrame, path: str, checkpoint: str, interval: str | None = DEFAULT_INTERVAL
) -> StreamingQuery:
    """Appends a stream of documents, each exactly once per checkpoint."""
    return start(df, "parquet", checkpoint, path, interval)


def latest_by_id(df: DataFrame, id: str, order: list[str]) -> DataFrame:
    """The last document of each id.

    A grouped maximum, not a ranking window: each task reduces its own rows first, so an id
    that holds a third of the table never lands whole in one task. Rows that tie in ``order``
    are told apart by their remaining columns.
    """
    rest = [c for c in df.columns if c != id and c not in order]
    last = df.groupBy(id).agg(F.max(F.struct(*order, *rest)).alias("_last"))
    return last.select(id, "_last.*").select(*df.columns)


def upsert_index(existing: DataFrame, updates: DataFrame, id: str, order: list[str]) -> DataFrame:
    """The index after the updates: each updated id is replaced, the others stay.

    Only the updates are reduced. The stored documents pass through an anti join on the
    updated ids, which turns into a broadcast when those are few.
    """
    latest = latest_by_id(updates, id, order)
    kept = existing.join(latest.select(id), id, "left_anti")
    return kept.unionByName(latest).select(*existing.columns)


def bucket_of(id: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(id), F.lit(buckets)).cast("int")


def merge_into_index(
    spark: SparkSession, path: str, updates: DataFrame, id: str, order: list[str], buckets: int = 64
) -> None:
    """Upserts into a stored index that is partitioned by a hash of the id.

    Only the buckets that hold an updated id are read and rewritten. An index keeps the bucket
    number it was created with, in the name of a file beside the data; another one is refused. A stored document that comes after an
    update in ``order`` stays. The new state of the buckets is written aside under the shared
    folder first, so a failed rewrite can be repeated from there.
    """
    latest = latest_by_id(updates, id, order).withColumn("_bucket", bucket_of(id, buckets))
    aside = scratch_path(spark, "updates")
    latest.write.parquet(aside)
    latest = spark.read.schema(latest.schema).parquet(aside)
    if not _path_exists(spark, path):
        latest.hint("rebalance", F.col("_bucket")).write.partitionBy("_bucket").parquet(path)
        _mark_buckets(spark, path, buckets)
        return
    # at most `buckets` integers reach the driver
    touched = [r["_bucket"] for r in latest.select("_bucket").distinct().collect()]
    index = spark.read.parquet(path)
    if not _path_exists(spark, _bucket_mark(path, buckets)):
        # an index without a mark: every row must lie in its bucket
        if _bucket_marks(spark, path) or not index.filter(bucket_of(id, buckets) != F.col("_bucket")).isEmpty():
            raise ValueError(f"the index at {path} has another number of buckets than {buckets}")
        _mark_buckets(spark, path, buckets)
    stored = index.filter(F.col("_bucket").isin(touched))
    replaced = stored.join(latest.select(id), id, "left_semi").unionByName(latest)
    merged = stored.join(latest.select(id), id, "left_anti").unionByName(latest_by_id(replaced, id, order))
    aside = scratch_path(spark, "merge")
    merged.select(*stored.columns).hint("rebalance", F.col("_bucket")).write.parquet(aside)
    (
        spark.read.parquet(aside).hint("rebalance", F.col("_bucket"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("_bucket")
        .parquet(path)
    )


def _bucket_mark(path: str, buckets: int) -> str:
    """An empty file beside the data that names the bucket number; readers skip names with an underscore."""
    return f"{path}/_buckets-{buckets}"


def _bucket_marks(spark: SparkSession, path: str) -> list[str]:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    names = [s.getPath().getName() for s in hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(hadoop_path)]
    return [n for n in names if n.startswith("_buckets-")]


def _mark_buckets(spark: SparkSession, path: str, buckets: int) -> None:
    mark = spark._jvm.org.apache.hadoop.fs.Path(_bucket_mark(path, buckets))
    mark.getFileSystem(spark._jsc.hadoopConfiguration()).create(mark, True).close()


def _path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)
