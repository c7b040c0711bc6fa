"""Versioned manifests: what makes a set of written folders appear at once.

A manifest is one small file of JSON under ``_manifests``; it appears whole, under the next number,
by a rename that refuses an existing name. Whoever reads takes the newest one and sees a commit
entirely or not at all; folders that no manifest names do not exist for readers. Writers may run
beside each other where such a rename exists (HDFS, local disks); on object stores let one writer
commit at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

ATTEMPTS = 20


def hadoop(spark: SparkSession, path: str) -> tuple:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def names(spark: SparkSession, path: str) -> list[str]:
    place, files = hadoop(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(place)) if files.exists(place) else []


def versions(spark: SparkSession, path: str) -> list[int]:
    """The numbers of all manifests, ascending."""
    return [int(n.removesuffix(".json")) for n in names(spark, f"{path}/_manifests") if n.endswith(".json")]


def manifest_path(path: str, version: int) -> str:
    return f"{path}/_manifests/{version:012d}.json"


def manifest(spark: SparkSession, path: str, version: int | None = None) -> dict | None:
    """The manifest of a version, by default the newest; None where nothing was committed."""
    if version is None:
        known = versions(spark, path)
        if not known:
            return None
        version = known[-1]
    place, files = hadoop(spark, manifest_path(path, version))
    stream = files.open(place)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")) | {"version": version}
    finally:
        stream.close()


def publish(spark: SparkSession, path: str, state: dict, version: int) -> bool:
    """Writes a manifest under its number; False where another writer has taken that number."""
    aside, files = hadoop(spark, f"{path}/_manifests/.{uuid.uuid4().hex}")
    out = files.create(aside, False)
    out.write(bytearray(json.dumps({k: v for k, v in state.items() if k != "version"}).encode()))
    out.close()
    fs = spark._jvm.org.apache.hadoop.fs
    context = fs.FileContext.getFileContext(files.makeQualified(aside).toUri(), spark._jsc.hadoopConfiguration())
    no_options = spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 0)
    try:
        context.rename(files.makeQualified(aside), files.makeQualified(fs.Path(manifest_path(path, version))), no_options)
        return True
    except Py4JJavaError as error:
        files.delete(aside, False)
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise


def commit(spark: SparkSession, path: str, change: Callable[[dict | None], dict | None]) -> bool:
    """Publishes what ``change`` makes of the newest manifest, anew where another writer was first.

    False where ``change`` gives None: there is nothing left to do.
    """
    for _ in range(ATTEMPTS):
        now = manifest(spark, path)
        then = change(now)
        if then is None:
            return False
        if publish(spark, path, then, now["version"] + 1 if now else 0):
            return True
    raise RuntimeError(f"other writers were first {ATTEMPTS} times at {path}")
