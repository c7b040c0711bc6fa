"""Near-duplicate documents by b-bit MinHash.

A document's set holds its distinct shingles of five words. ``HASHES`` minima are taken; bands of
``ROWS`` whole minima give candidate buckets, and the lowest ``BITS`` bits of every minimum are
packed into a signature of a few longs. The share of equal b-bit values of two signatures, less
what chance collisions add, estimates the similarity; candidates well below the threshold go no
further, and all others are confirmed on their full sets.

Documents with equal sets form a class, and only one member of a class takes part (classes are
joined by two 64-bit sums over the set). Within a bucket nobody is paired with everybody:

1. every member is paired with the bucket's smallest id, and confirmed links form components;
2. in buckets that still span several components, members with a good estimate across components
   are picked out, and only these are compared on their full sets, across components, block
   against block within tasks. A block gives each member the least id that it is linked with.

No pairs are written in the second step, and after it every candidate pair is within one component
or was tested, so components are those of all candidate pairs. Bands find a pair at the threshold with a probability over
0.9999 (25 bands of 5 rows).

Defined results: null or empty texts have an empty set and link with nothing; so does a null id,
whose component is null and which is kept. Rows that share an id are one document for links.
Repeated rows each get a row. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.llm import textbytes as tb
from curbflow.llm.groups import block_pairs, components, least_linked, sides, sorted_groups, stored
from curbflow.llm.workers import lean

WORDS, ROWS, BANDS, BITS = 5, 5, 25, 4
HASHES = ROWS * BANDS
MARGIN = 0.16  # an estimate may lie so far below the threshold: over four standard deviations
BLOCK = 512  # members that are compared with one another at once
BROADCAST_IDS = 200_000  # ids that are broadcast at most; more are joined by shuffle

_LONGS = -(-HASHES * BITS // 64)
_WORD = tb.byte_table(lambda b: b != 32 and not 9 <= b <= 13)
_ODD = np.random.default_rng(7).integers(0, 2**31, (3, HASHES + WORDS + ROWS), np.uint64) * np.uint64(2) + np.uint64(1)
_TIMES, _PLUS = _ODD[0, :HASHES].astype(np.uint32), _ODD[1, :HASHES].astype(np.uint32)
_PLACE = tb.mixed(_ODD[2, :WORDS]) | np.uint64(1)
_ROW = tb.mixed(_ODD[2, WORDS : WORDS + ROWS]) | np.uint64(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each document."""
    words, starts, _ = tb.hashed_words(data, offsets, _WORD)
    rows = tb.word_rows(starts, offsets)
    if len(words) >= WORDS:
        n = len(words) - WORDS + 1
        shingles = tb.mixed(sum(words[k : n + k] * _PLACE[k] for k in range(WORDS)))
    for a, b in zip(rows, rows[1:]):
        if b - a >= WORDS:
            yield np.unique(shingles[a : b - WORDS + 1])
        elif b > a:
            yield tb.mixed(np.array([(words[a:b] * _PLACE[: b - a]).sum() + np.uint64(b - a)], np.uint64))
        else:
            yield np.zeros(0, np.uint64)


def minima(shingles: np.ndarray) -> np.ndarray:
    out = np.full(HASHES, np.iinfo(np.uint32).max, np.uint32)
    x = (shingles >> np.uint64(32)).astype(np.uint32) ^ shingles.astype(np.uint32)
    for k in range(0, len(x), 4096):
        out = np.minimum(out, (x[k : k + 4096, None] * _TIMES + _PLUS).min(0))
    return out


def packed(low: np.ndarray) -> np.ndarray:
    """The low bits of the minima (documents x HASHES), ``64 // BITS`` to a long."""
    per = 64 // BITS
    wide = np.zeros((len(low), _LONGS * per), np.uint64)
    wide[:, :HASHES] = low & ((1 << BITS) - 1)
    shifts = (np.arange(per) * BITS).astype(np.uint64)
    return (wide.reshape(len(low), _LONGS, per) << shifts).sum(2, dtype=np.uint64)


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, the two sums that name the set, signature and band keys of every row."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tb.utf8(batch.column(1))
            for first, last in tb.blocks(offsets):
                sizes, least, sums = [], [], []
                for s in shingle_sets(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]):
                    sizes.append(len(s))
                    least.append(minima(s))
                    sums.append((s.sum(dtype=np.uint64), tb.mixed(s).sum(dtype=np.uint64)))
                least, sums = np.array(least), np.array(sums, np.uint64).view(np.int64)
                keys = (least.reshape(-1, BANDS, ROWS).astype(np.uint64) * _ROW).sum(2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first), pa.array(sizes, pa.int64()),
                        pa.array(sums[:, 0]), pa.array(sums[:, 1]),
                        _lists(packed(least).view(np.int64)), _lists(tb.mixed(keys).view(np.int64)),
                    ],
                    names=["doc_id", "n_shingles", "sum_a", "sum_b", "signature", "bands"],
                )

    schema = "doc_id long, n_shingles long, sum_a long, sum_b long, signature array<long>, bands array<long>"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(lean(task), schema)


def _lists(table: np.ndarray) -> pa.Array:
    flat = pa.array(np.ascontiguousarray(table).ravel())
    return pa.ListArray.from_arrays(pa.array(np.arange(len(table) + 1, dtype=np.int32) * table.shape[1]), flat)


def estimate(a: str, b: str) -> str:
    """SQL: the collision-corrected similarity of two signatures.

    With chance c = 2^-BITS of equal low bits, the expected share of equal values is J + (1 - J) c.
    """
    ones = int("1" * (64 // BITS), 1 << BITS)
    unequal = "(x | shiftrightunsigned(x, 1) | shiftrightunsigned(x, 2) | shiftrightunsigned(x, 3))"
    count = f"aggregate(transform(zip_with({a}, {b}, (p, q) -> p ^ q), x -> bit_count({unequal} & {ones}L)), 0, (s, k) -> s + CAST(k AS INT))"
    chance = 2.0**-BITS
    return f"(((1D - {count} / {HASHES}D) - {chance}D) / {1 - chance}D)"


def full_sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, shingles) of the documents in ``ids``."""
    ids = stored(docs.sparkSession, ids.select("doc_id").distinct(), "ids")
    few = ids.count() <= BROADCAST_IDS
    some = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(F.broadcast(ids) if few else ids, "doc_id")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tb.utf8(batch.column(1))
            for first, last in tb.blocks(offsets):
                sets = list(shingle_sets(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]))
                at = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.ListArray.from_arrays(pa.array(at), pa.array(flat))],
                    names=["doc_id", "shingles"],
                )

    return stored(docs.sparkSession, some.mapInArrow(lean(task), "doc_id long, shingles array<long>"), "sets")


def confirmed(docs: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have a Jaccard similarity of at least ``percent`` / 100."""
    sets = full_sets(docs, pairs.select(F.explode(F.array("a", "b")).alias("doc_id")))
    left, right = sets.toDF("a", "set_a"), sets.toDF("b", "set_b")
    both = F.size(F.array_intersect("set_a", "set_b"))
    whole = F.size("set_a") + F.size("set_b") - both
    joined = pairs.join(left, "a").join(right, "b")
    return joined.where(100 * both.cast("long") >= percent * whole.cast("long")).select("a", "b").distinct()


def _promising(least: float):
    """(key, doc_id) of members with a good estimate with a member of another component."""

    def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
        column = lambda name: table.column(name).to_numpy()
        group, second, parts = column("group"), column("second"), column("component")
        codes = table.column("signature").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(group), -1)
        hit = np.zeros(len(group), bool)
        edges = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(group)]])
        for low, high in zip(edges, edges[1:]):
            left, right = sides(second, low, high)
            for k in range(0, len(left), 128):
                rows = left[k : k + 128]
                good = _similarity(codes[rows], codes[right]) >= least
                good &= parts[rows][:, None] != parts[right][None]
                hit[rows] |= good.any(1)
                hit[right] |= good.any(0)
        yield pa.RecordBatch.from_arrays([pa.array(column("key")[hit]), pa.array(column("doc_id")[hit])], names=["key", "doc_id"])

    return lambda batches: sorted_groups(batches, "group", work)


def _similarity(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    ones = np.uint64(int("1" * (64 // BITS), 1 << BITS))
    x = a[:, None, :] ^ b[None, :, :]
    x |= x >> np.uint64(1)
    x |= x >> np.uint64(2)
    equal = 1 - np.bitwise_count(x & ones).sum(2) / HASHES
    return (equal - 2.0**-BITS) / (1 - 2.0**-BITS)


def _linked(percent: int):
    """(a, b): members and the least id each is linked with in its block, on full sets."""

    def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
        column = lambda name: table.column(name).to_numpy()
        group, second, parts, ids = column("group"), column("second"), column("component"), column("doc_id")
        lists = table.column("shingles").combine_chunks()
        flat, at = lists.flatten().to_numpy(), lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
        sizes = np.diff(at)
        edges = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(group)]])
        for low, high in zip(edges, edges[1:]):
            left, right = sides(second, low, high)
            if high - low < 2 or not len(left) or not len(right):
                continue
            holder = np.repeat(np.arange(len(right)), sizes[right])
            words = np.concatenate([flat[at[r] : at[r + 1]] for r in right])
            order = np.argsort(words, kind="stable")
            words, holder = words[order], holder[order]
            i, j = [], []
            for k in left:  # common shingles with all of the other side at once
                own = flat[at[k] : at[k + 1]]
                begin, end = np.searchsorted(words, own), np.searchsorted(words, own, side="right")
                many = end - begin
                inner = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
                both = np.bincount(holder[np.repeat(begin, many) + inner], minlength=len(right))
                good = (100 * both >= percent * (sizes[k] + sizes[right] - both)) & (parts[right] != parts[k])
                j.append(right[good])
                i.append(np.full(int(good.sum()), k))
            i, j = np.concatenate(i), np.concatenate(j)
            if len(i):
                label = least_linked(ids[low:high], i - low, j - low)
                some = label != ids[low:high]
                yield pa.RecordBatch.from_arrays([pa.array(label[some]), pa.array(ids[low:high][some])], names=["a", "b"])

    return lambda batches: sorted_groups(batches, "group", work)


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs``."""
    spark, least = docs.sparkSession, percent / 100 - MARGIN
    rows = stored(spark, signatures(docs), "signatures")
    named = ["sum_a", "sum_b", "n_shingles"]
    classes = stored(spark, rows.where("n_shingles > 0").groupBy(*named).agg(F.min("doc_id").alias("class")), "classes")
    heads = stored(
        spark,
        rows.join(classes, named).where("doc_id = class").select("doc_id", "signature", "bands"),
        "heads",
    )
    keys = heads.select("doc_id", F.explode("bands").alias("key"))
    hubs = keys.groupBy("key").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("last")).where("a < last").drop("last")
    members = stored(spark, keys.join(hubs, "key"), "members")  # of buckets with several documents
    code = heads.select("doc_id", "signature")

    def estimated(pairs: DataFrame) -> DataFrame:
        joined = pairs.join(code.toDF("a", "sig_a"), "a").join(code.toDF("b", "sig_b"), "b")
        return joined.where(f"{estimate('sig_a', 'sig_b')} >= {least}D").select("a", "b").distinct()

    stars = members.where("a <> doc_id").select("a", F.col("doc_id").alias("b")).distinct()
    links = stored(spark, confirmed(docs, stored(spark, estimated(stars), "pairs"), percent), "links")
    joined = components(spark, links)
    placed = members.select("key", "doc_id").join(joined.withColumnRenamed("id", "doc_id"), "doc_id", "left").select(
        "key", "doc_id", F.coalesce("component_id", "doc_id").alias("component")
    )
    split = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    open_ = stored(spark, placed.join(split.select("key"), "key"), "open")
    met = block_pairs(open_.join(code, "doc_id"), "key", "doc_id", BLOCK)
    picked = stored(spark, met.mapInArrow(lean(_promising(least)), "key long, doc_id long").distinct(), "picked")
    if not picked.isEmpty():
        sets = full_sets(docs, picked).dropDuplicates(["doc_id"])
        met = block_pairs(picked.join(open_, ["key", "doc_id"]), "key", "doc_id", BLOCK).join(sets, "doc_id")
        met = met.repartition("group").sortWithinPartitions("group")
        links = links.union(stored(spark, met.mapInArrow(lean(_linked(percent)), "a long, b long").distinct(), "links"))
        joined = components(spark, links)
    out = rows.drop("signature", "bands").join(classes, named, "left").join(joined.withColumnRenamed("id", "class"), "class", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "class", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), percent=85)


_SQL_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# All pairs that share a shingle, on whole sets.
ORACLES = {
    "op10_minhash": rf"""WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_SQL_LOWER}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, ws[i:i + {WORDS - 1}] AS sh
  FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(len(ws) - {WORDS - 1}, 1))) AS i FROM w WHERE len(ws) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared.n >= 85 * (x.n + y.n - shared.n)),
reach(a, b) AS (SELECT doc_id, doc_id FROM w UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM least LEFT JOIN sizes USING (doc_id)"""
}
