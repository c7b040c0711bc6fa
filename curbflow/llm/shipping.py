"""Gives the Python workers this package, as ``--py-files`` would, where they may not have it, and small batches."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession


BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 512  # rows of whole texts that go to Python at once, unless the session sets its own number


def ship(spark: SparkSession) -> SparkSession:
    """Adds the package to the session once; Spark's own file service hands it to every executor."""
    if spark.conf.get(BATCH_CONF) == "10000":
        spark.conf.set(BATCH_CONF, str(BATCH_ROWS))
    context = spark.sparkContext
    if not getattr(context, "_curbflow_shipped", False):
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = os.path.join(tempfile.mkdtemp(), "curbflow.zip")
        with zipfile.ZipFile(path, "w") as out:
            for folder, _, names in os.walk(root):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        out.write(full, os.path.relpath(full, os.path.dirname(root)))
        context.addPyFile(path)
        context._curbflow_shipped = True
    return spark
