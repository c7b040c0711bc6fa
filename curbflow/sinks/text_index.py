"""Text search on a stored index: a table from tokens to documents, kept up with each commit.

``tokens`` holds one row for each distinct token of a text, in buckets by the token's hash, sorted by
token, with Bloom filters. ``fields`` holds the other columns of the latest version of each document
as an upsert index. A search reads the buckets of its own tokens, finds the documents that hold a
token of every clause in one grouped pass, and joins their fields; no text is read.

A commit writes the tokens first, then the fields, so whoever sees a document also sees its tokens.
Every row bears a 64-bit hash of the text it was made from: tokens of texts that were replaced no
longer agree with the fields and count for nothing. ``compact`` folds buckets of many folders.

Defined results: a null text has no tokens; a clause without tokens matches nothing; no clause
matches every document; a null id is an id like any other; of versions that tie in ``order`` the one
with the greatest other columns counts, then with the greatest hash of the text.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from curbflow.functions.predicates import TOKEN_BREAK, query_tokens
from curbflow.sinks import upserts
from curbflow.sinks.index import bucket_of
from curbflow.sinks.manifests import commit, manifest
from curbflow.sinks.streams import DEFAULT_INTERVAL, start_batches

_TOKEN, _DOC, _MARK = "_token", "_doc", "_mark"


def text_tokens(text: Column | str) -> Column:
    """The distinct lower-case tokens of a text."""
    text = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.array_distinct(F.split(F.lower(text), TOKEN_BREAK)), "")


def _tokens_path(path: str) -> str:
    return f"{path}/tokens"


def _fields_path(path: str) -> str:
    return f"{path}/fields"


def index_texts(
    spark: SparkSession,
    path: str,
    docs: DataFrame,
    id: str,
    order: list[str],
    text: str = "text",
    buckets: int = 64,
    batch: tuple[str, int] | None = None,
) -> bool:
    """Commits the documents' tokens and fields; False where nothing was to do.

    ``batch`` names a stream and the number of its batch, which is committed once.
    """
    tokens, kind = _tokens_path(path), docs.schema[id].dataType.jsonValue()
    marked = docs.withColumn(_MARK, F.xxhash64(F.coalesce(F.col(text), F.lit(""))))

    def known(state: dict | None) -> bool:
        if state and (state["buckets"], state["id"], state["kind"]) != (buckets, id, kind):
            raise ValueError(f"the index at {path} was made with other buckets or another id")
        return bool(state and batch and state["streams"].get(batch[0], -1) >= batch[1])

    if not known(manifest(spark, tokens)):
        held = marked.select(F.explode(text_tokens(text)).alias(_TOKEN), F.col(id).alias(_DOC), _MARK)
        written = upserts.write_buckets(spark, tokens, held, _TOKEN, buckets)

        def change(state: dict | None) -> dict | None:
            if known(state):
                return None
            state = state or {"buckets": buckets, "id": id, "kind": kind, "streams": {}, "folders": {}}
            folders = state["folders"] | {b: state["folders"].get(b, []) + [f] for b, f in written.items()}
            return state | {"folders": folders, "streams": state["streams"] | ({batch[0]: batch[1]} if batch else {})}

        commit(spark, tokens, change)
    return upserts.upsert(spark, _fields_path(path), marked.drop(text), id, order, buckets, batch)


def _read_tokens(spark: SparkSession, path: str, state: dict, folders: dict[str, list[str]]) -> DataFrame:
    kind = T.StructField.fromJson({"name": _DOC, "type": state["kind"], "nullable": True, "metadata": {}})
    schema = T.StructType([T.StructField(_TOKEN, T.StringType()), kind, T.StructField(_MARK, T.LongType())])
    return upserts.read_folders(spark, _tokens_path(path), schema, folders)


def _rows_of(spark: SparkSession, path: str, wanted: list[str]) -> DataFrame | None:
    """The token rows of some tokens, from their own buckets; None where nothing was committed."""
    state = manifest(spark, _tokens_path(path))
    if state is None:
        return None
    asked = spark.createDataFrame([(t,) for t in wanted], f"{_TOKEN} string")
    # at most as many numbers as tokens
    hit = {str(r["b"]) for r in asked.select(bucket_of(_TOKEN, state["buckets"]).alias("b")).distinct().collect()}
    folders = {b: own for b, own in state["folders"].items() if b in hit}
    return _read_tokens(spark, path, state, folders).filter(F.col(_TOKEN).isin(wanted))


def search_texts(
    spark: SparkSession, path: str, must: list[str] = (), filters: Column | None = None, fields: list[str] | None = None
) -> DataFrame:
    """The documents that hold a token of every ``must`` query and pass the filters on their fields."""
    # the fields first: their tokens were committed before them
    docs = upserts.read_upserts(spark, _fields_path(path))
    id = manifest(spark, _fields_path(path))["id"]
    kept = docs if filters is None else docs.filter(filters)
    columns = fields or [c for c in docs.columns if c != _MARK]
    clauses = [query_tokens(q) for q in must]
    if clauses:
        held = _rows_of(spark, path, sorted({t for c in clauses for t in c})) if all(clauses) else None
        if held is None:
            return kept.filter(F.lit(False)).select(*columns)
        tests = [F.bool_or(F.col(_TOKEN).isin(c)).alias(f"_c{i}") for i, c in enumerate(clauses)]
        found = held.groupBy(_DOC, F.col(_MARK).alias("_made")).agg(*tests)
        found = found.filter(reduce(lambda a, b: a & b, [F.col(f"_c{i}") for i in range(len(clauses))]))
        kept = kept.join(found, F.col(id).eqNullSafe(F.col(_DOC)) & (F.col(_MARK) == F.col("_made")), "left_semi")
    return kept.select(*columns)


def compact(spark: SparkSession, path: str, above: int = 1) -> int:
    """Folds each bucket of tokens and of fields with more than ``above`` folders; their number."""
    tokens = _tokens_path(path)
    state = manifest(spark, tokens)
    many = {b: own for b, own in state["folders"].items() if len(own) > above} if state else {}
    folded = upserts.compact(spark, _fields_path(path), above)
    if not many:
        return folded
    written = upserts.write_buckets(spark, tokens, _read_tokens(spark, path, state, many).distinct(), _TOKEN, state["buckets"])

    def change(now: dict) -> dict | None:
        if any(f not in now["folders"][b] for b, own in many.items() for f in own):
            return None
        return now | {"folders": now["folders"] | {b: [written[b]] + [f for f in now["folders"][b] if f not in own] for b, own in many.items()}}

    return folded + (len(many) if commit(spark, tokens, change) else 0)


def index_step(
    path: str, stream: str, id: str, order: list[str], text: str = "text", buckets: int = 64, above: int = 8
) -> Callable[[DataFrame, int], None]:
    """What a micro-batch does: one commit, and a compaction of buckets with too many folders."""

    def step(batch: DataFrame, batch_id: int) -> None:
        index_texts(batch.sparkSession, path, batch, id, order, text, buckets, (stream, batch_id))
        compact(batch.sparkSession, path, above)

    return step


def stream_texts(
    df: DataFrame, path: str, checkpoint: str, id: str, order: list[str], text: str = "text", buckets: int = 64, interval: str | None = DEFAULT_INTERVAL, above: int = 8
) -> StreamingQuery:
    """Indexes a stream of documents, each batch once; the checkpoint's path names the stream."""
    return start_batches(df, index_step(path, checkpoint, id, order, text, buckets, above), checkpoint, interval)
