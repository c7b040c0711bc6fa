"""Readers for trip files, archived points, documents and stored indices."""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbflow.functions.text import parse_point
from curbflow.schemas import TRIP_ALIASES, TRIP_COLUMNS


def _field_count(line: Column, sep: str) -> Column:
    unquoted = F.regexp_replace(line, '"[^"]*"', "")
    return F.length(unquoted) - F.length(F.replace(unquoted, F.lit(sep), F.lit(""))) + 1


def read_trips_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType = TRIP_COLUMNS,
    aliases: dict[str, tuple[str, ...]] = TRIP_ALIASES,
    sep: str = ",",
) -> DataFrame:
    """Trips from delimited files with a header, local or in object storage.

    Columns are found by header name, under their own name or an alias. Rows with more
    fields than the header are skipped, shorter ones are padded with nulls, empty lines are
    skipped, and values that do not fit the declared type become null. Every file has its own
    header: files of several layouts may lie in one path. One pass finds the first line of every
    file; the distinct headers, one for each layout, reach the driver.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"))
    numbered = lines.filter("_start = 0").withColumn("_at", F.monotonically_increasing_id())
    headers = numbered.groupBy("_file").agg(F.min_by("value", "_at").alias("_header"))
    layouts = sorted(r[0] for r in headers.select("_header").distinct().collect())
    if not layouts:
        return spark.createDataFrame([], schema)
    if len(layouts) == 1:
        rows = lines.withColumn("_header", F.lit(layouts[0]))
    else:
        rows = lines.join(headers, "_file")
    rows = rows.filter((F.col("value") != F.col("_header")) & (F.length("value") > 0))
    names = [[n.strip().lstrip("\ufeff") for n in next(csv.reader([line], delimiter=sep))] for line in layouts]
    fields = _field_count(F.col("value"), sep)
    parsed = []
    for line, header in zip(layouts, names):
        raw = T.StructType([T.StructField(f"_{i}", T.StringType()) for i in range(len(header))])
        fits = (F.col("_header") == F.lit(line)) & (fields <= len(header))
        parsed.append(F.when(fits, F.from_csv("value", raw.simpleString()[7:-1].replace(":", " "), {"sep": sep})))
    rows = rows.select(*[p.alias(f"r{k}") for k, p in enumerate(parsed)])
    rows = rows.filter(reduce(lambda a, b: a | b, [F.col(f"r{k}").isNotNull() for k in range(len(layouts))]))

    def typed(f: T.StructField) -> Column:
        values = []
        for k, header in enumerate(names):
            at = next((header.index(n) for n in (f.name, *aliases.get(f.name, ())) if n in header), None)
            if at is not None:
                values.append(F.col(f"r{k}").getField(f"_{at}").try_cast(f.dataType))
        value = F.coalesce(*values) if values else F.lit(None).cast(f.dataType)
        return value.alias(f.name)

    return rows.select(*[typed(f) for f in schema.fields])


def read_point_files(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Points ``(x, y)`` from text files with one ``[x,y]`` per line; other lines are dropped."""
    reader = spark.readStream if streaming else spark.read
    points = reader.text(path).select(parse_point("value").alias("_p"))
    return points.filter(F.size("_p") == 2).select(
        F.get("_p", 0).alias("x"), F.get("_p", 1).alias("y")
    )


def load_documents(
    spark: SparkSession, path: str, schema: T.StructType, date_format: str | None = None
) -> DataFrame:
    """JSON-line documents under a declared schema: unknown fields go, missing ones are null."""
    reader = spark.read.schema(schema)
    if date_format:
        reader = reader.option("dateFormat", date_format)
    return reader.json(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Every document of a stored index."""
    return spark.read.parquet(path)
