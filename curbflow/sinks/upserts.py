"""An index that streams and batches upsert into: files for each commit, merged when read.

A commit writes the latest document of each of its ids into a folder of its own, split by a hash
of the id and sorted by it, and then names that folder in a new manifest. The manifest is one small
file that appears whole under the next version number; it holds the schema, the number of buckets,
the last batch of each stream, and the live folders of each bucket. A reader takes the newest
manifest and sees a commit entirely or not at all. A batch that is run again finds its number in
the manifest and changes nothing; what a failed attempt has written is named nowhere.

Among the folders of a bucket the last document in ``order`` wins, so their sequence does not
matter. ``compact`` folds buckets with many folders into one folder, one bucket for itself. Writers
may run beside each other where a rename refuses an existing name (HDFS, local disks); on object
stores let one writer commit at a time.

Defined results: a null id is an id like any other; documents that tie in ``order`` are told apart
by their other columns; an empty batch commits nothing.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from curbflow.sinks.index import bucket_of, latest_by_id
from curbflow.sinks.manifests import commit, hadoop, manifest, manifest_path, names, versions
from curbflow.sinks.streams import DEFAULT_INTERVAL, start_batches

_BUCKET = "_bucket"


def write_buckets(spark: SparkSession, path: str, latest: DataFrame, id: str, buckets: int) -> dict[str, str]:
    """Writes documents into a new folder; its name for each bucket that holds any."""
    folder = f"part-{uuid.uuid4().hex}"
    bucketed = latest.withColumn(_BUCKET, bucket_of(id, buckets)).hint("rebalance", F.col(_BUCKET))
    (
        bucketed.sortWithinPartitions(_BUCKET, id)
        .write.partitionBy(_BUCKET)
        .option(f"parquet.bloom.filter.enabled#{id}", "true")
        .parquet(f"{path}/{folder}")
    )
    prefix = f"{_BUCKET}="
    return {n.removeprefix(prefix): folder for n in names(spark, f"{path}/{folder}") if n.startswith(prefix)}


def _check(state: dict, path: str, id: str, order: list[str], buckets: int, schema: T.StructType) -> None:
    given = {"id": id, "order": list(order), "buckets": buckets}
    wrong = [k for k, v in given.items() if state[k] != v]
    kept = {f.name: f.dataType for f in T.StructType.fromJson(state["schema"])}
    if kept != {f.name: f.dataType for f in schema}:
        wrong.append("schema")
    if wrong:
        raise ValueError(f"the index at {path} was made with another {', '.join(wrong)}")


def upsert(
    spark: SparkSession, path: str, updates: DataFrame, id: str, order: list[str], buckets: int = 64, batch: tuple[str, int] | None = None
) -> bool:
    """Commits the latest document of each id of ``updates``; False where nothing was to do.

    ``batch`` names a stream and the number of its batch; a number that is not above the last
    committed one of that stream was committed before. Other buckets, id, order or columns than
    those that the index was made with are refused.
    """
    def known(state: dict | None) -> bool:
        if state:
            _check(state, path, id, order, buckets, updates.schema)
        return bool(state and batch and state["streams"].get(batch[0], -1) >= batch[1])

    if known(manifest(spark, path)):
        return False
    schema = updates.schema
    written = write_buckets(spark, path, latest_by_id(updates, id, order), id, buckets)
    if not written:
        return False

    def change(state: dict | None) -> dict | None:
        if known(state):
            return None
        state = state or {"id": id, "order": list(order), "buckets": buckets, "schema": schema.jsonValue(), "streams": {}, "folders": {}}
        folders = dict(state["folders"])
        for bucket, folder in written.items():
            folders[bucket] = folders.get(bucket, []) + [folder]
        streams = state["streams"] | ({batch[0]: batch[1]} if batch else {})
        return state | {"folders": folders, "streams": streams}

    return commit(spark, path, change)


def read_folders(spark: SparkSession, path: str, schema: T.StructType, folders: dict[str, list[str]]) -> DataFrame:
    """The rows of some buckets, each with the folders that hold it."""
    paths = [f"{path}/{f}/{_BUCKET}={bucket}" for bucket, own in folders.items() for f in own]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _files(spark: SparkSession, path: str, state: dict, folders: dict[str, list[str]]) -> DataFrame:
    return read_folders(spark, path, T.StructType.fromJson(state["schema"]), folders)


def read_upserts(spark: SparkSession, path: str, buckets: list[int] | None = None, version: int | None = None) -> DataFrame:
    """The documents of all or some buckets, by the newest manifest or an earlier one.

    Buckets that lie in one folder hold each id once and are read as they are; only the others are
    merged, by one grouped maximum.
    """
    state = manifest(spark, path, version)
    if state is None:
        raise FileNotFoundError(f"nothing was committed at {path}")
    wanted = None if buckets is None else {str(b) for b in buckets}
    folders = {b: own for b, own in state["folders"].items() if wanted is None or b in wanted}
    single = _files(spark, path, state, {b: own for b, own in folders.items() if len(own) == 1})
    several = {b: own for b, own in folders.items() if len(own) > 1}
    if not several:
        return single
    merged = latest_by_id(_files(spark, path, state, several), state["id"], state["order"])
    return single.unionByName(merged)


def lookup(spark: SparkSession, path: str, ids: list) -> DataFrame:
    """The documents of the ids. Only their buckets are listed and read, and in those the sorted
    ids and the Bloom filters of the files let the scan pass over row groups."""
    state = manifest(spark, path)
    if state is None:
        raise FileNotFoundError(f"nothing was committed at {path}")
    id = state["id"]
    kind = T.StructType.fromJson(state["schema"])[id].dataType
    asked = spark.createDataFrame([(i,) for i in ids], T.StructType([T.StructField(id, kind)]))
    # at most as many numbers as ids
    hit = [r["b"] for r in asked.select(bucket_of(id, state["buckets"]).alias("b")).distinct().collect()]
    test = F.col(id).isin([i for i in ids if i is not None])
    if any(i is None for i in ids):
        test = test | F.col(id).isNull()
    return read_upserts(spark, path, hit, state["version"]).filter(test)


def compact(spark: SparkSession, path: str, above: int = 1) -> int:
    """Folds each bucket of more than ``above`` folders into one folder; the number of buckets.

    Commits that come in meanwhile stay beside the new folder. Where another compaction has folded
    the same folders first, this one leaves its own unnamed.
    """
    state = manifest(spark, path)
    many = {b: own for b, own in state["folders"].items() if len(own) > above} if state else {}
    if not many:
        return 0
    merged = latest_by_id(_files(spark, path, state, many), state["id"], state["order"])
    written = write_buckets(spark, path, merged, state["id"], state["buckets"])

    def change(now: dict) -> dict | None:
        if any(f not in now["folders"][b] for b, own in many.items() for f in own):
            return None
        folded = {b: [written[b]] + [f for f in now["folders"][b] if f not in own] for b, own in many.items()}
        return now | {"folders": now["folders"] | folded}

    return len(many) if commit(spark, path, change) else 0


def vacuum(spark: SparkSession, path: str, keep: int = 10, older_than: float = 86400.0) -> int:
    """Deletes all but the newest ``keep`` manifests, and folders that none of these names and that
    were not changed for ``older_than`` seconds; the number of folders. The age spares commits that
    are under way and readers of manifests that go."""
    known = versions(spark, path)
    live = {f for v in known[-keep:] for own in manifest(spark, path, v)["folders"].values() for f in own}
    for v in known[:-keep]:
        place, files = hadoop(spark, manifest_path(path, v))
        files.delete(place, False)
    place, files = hadoop(spark, path)
    before, gone = (time.time() - older_than) * 1000, 0
    for status in files.listStatus(place) if files.exists(place) else []:
        name = status.getPath().getName()
        if name.startswith("part-") and name not in live and status.getModificationTime() < before:
            gone += bool(files.delete(status.getPath(), True))
    return gone


def upsert_step(
    path: str, stream: str, id: str, order: list[str], buckets: int = 64, above: int = 8
) -> Callable[[DataFrame, int], None]:
    """What a micro-batch does: one commit, and a compaction of buckets with too many folders."""

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        upsert(spark, path, batch, id, order, buckets, (stream, batch_id))
        compact(spark, path, above)

    return step


def stream_upserts(
    df: DataFrame, path: str, checkpoint: str, id: str, order: list[str], buckets: int = 64, interval: str | None = DEFAULT_INTERVAL, above: int = 8
) -> StreamingQuery:
    """Upserts a stream of documents by id, each batch once. The checkpoint's path names the stream
    in the manifest, so keep it for as long as its checkpoint lives."""
    return start_batches(df, upsert_step(path, checkpoint, id, order, buckets, above), checkpoint, interval)
