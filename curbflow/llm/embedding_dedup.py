"""Near-duplicate embeddings by iterative quantisation and multi-index Hamming tables.

Equal vectors form a class, of which one takes part. A sample of the vectors is centred and
projected on its principal axes, and rotations are learnt that bring the axes' signs closest to
the data (alternating between codes and the orthogonal rotation that fits them best), so that
codes are balanced. A code is cut into pieces; each piece of each rotation's code is a table, and
vectors with equal pieces meet in a bucket. There the original vectors are compared by their
cosine in double precision, block against block.

Pieces grow with the logarithm of the number of vectors, so buckets of unrelated vectors stay
small at any size. Centring widens the angles where vectors share a direction, so the number of
rotations is measured: vectors of the sample get partners at the threshold, and rotations are added
until the wanted share of them (``FOUND``) meets. Where that takes more tables than ``TABLES`` and
than there are blocks of vectors, all vectors are one bucket, and every pair is compared. A bucket of more than ``BLOCK`` vectors is dealt out as pairs of
blocks, each a task's group of its own. A pair that meets in several tables counts in the first.
Pairs are never written: blocks give each vector's number of links and its least relative.

Defined results: a vector that is null, empty or zero, or has a null or non-finite component, or
a null id links with nothing: n_links 0, itself as component (null for a null id), kept. Vectors
of different lengths do not link. Repeated rows are one vector and each get a row. Other columns
are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.llm.groups import components, least_linked, sorted_groups, stored
from curbflow.llm.textbytes import mixed

COSINE = 0.95
FIT_ROWS = 10_000  # vectors that the axes and rotations are learnt from, at most
STEPS = 30
FOUND = 0.98
SPARE_BITS = 4
BLOCK = 1024
TABLES = 256
PARTNERS = 2000  # vectors that get partners at the threshold, at most; others than those where there are enough


def learn(sample: np.ndarray, pieces: int, piece_bits: int, steps: int = STEPS):
    """(mean, projections without end): of each rotation the matrix from vectors to code values."""
    mean = sample.mean(0)
    centred = sample - mean
    bits = min(pieces * piece_bits, sample.shape[1])
    _, axes = np.linalg.eigh(centred.T @ centred)
    axes = axes[:, ::-1][:, :bits]

    def projections() -> Iterator[np.ndarray]:
        v = centred @ axes
        rng = np.random.default_rng(11)
        while True:
            r = np.linalg.qr(rng.normal(size=(bits, bits)))[0]
            for _ in range(steps):
                codes = np.where(v @ r >= 0, 1.0, -1.0)
                a, _, b = np.linalg.svd(codes.T @ v)
                r = (a @ b).T
            yield axes @ r

    return mean, projections()


def at_threshold(sample: np.ndarray, cosine: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """Vectors of the sample and partners at ``cosine``, apart in any direction or as the sample's own vectors are."""
    rng = np.random.default_rng(12)
    own = sample[-PARTNERS:]
    out = []
    for apart in (rng.normal(size=own.shape), sample[rng.integers(0, len(sample), len(own))] - sample[rng.integers(0, len(sample), len(own))]):
        apart = apart - (apart * own).sum(1, keepdims=True) * own
        size = np.sqrt((apart * apart).sum(1, keepdims=True))
        some = size[:, 0] > 1e-6
        if some.any():
            out.append((own[some], cosine * own[some] + math.sqrt(1 - cosine * cosine) * apart[some] / size[some]))
    return out


def fitted(sample: np.ndarray, count: int, cosine: float):
    """(model, pieces, bits of a piece) by which ``FOUND`` of the partners meet; None as model: compare all."""
    pieces, bits, rotations = plan(count, sample.shape[1], cosine)
    mean, source = learn(sample[:FIT_ROWS], pieces, bits)
    most = max(TABLES, math.ceil(count / BLOCK))
    pairs = at_threshold(sample, cosine)
    met = [np.zeros(len(u), bool) for u, _ in pairs]
    agree = [np.zeros(len(u)) for u, _ in pairs]
    out: list[np.ndarray] = []
    while len(out) < rotations or any(m.mean() < FOUND for m in met):
        if len(out) >= rotations:
            expected = [1 - ((1 - (a / len(out)) ** bits) ** most).mean() for a in agree]
            if (len(out) + 1) * pieces > most or min(expected) < FOUND:
                return None, 1, bits
        p = next(source)
        out.append(p)
        for m, a, (u, w) in zip(met, agree, pairs):
            m |= (keys(u, (mean, [p]), pieces, bits) == keys(w, (mean, [p]), pieces, bits)).any(1)
            a += (((u - mean) @ p >= 0) == ((w - mean) @ p >= 0)).mean(1)
    return (mean, out), pieces, bits


def plan(count: int, width: int, cosine: float) -> tuple[int, int, int]:
    """(pieces, bits of a piece, least rotations) for ``count`` vectors of ``width``."""
    bits = max(1, min(width, 63, math.ceil(math.log2(max(2, count))) + SPARE_BITS))
    pieces = max(1, min(width, 256) // bits)
    agree = 1 - math.acos(cosine) / math.pi
    tables = math.ceil(math.log(1 - FOUND) / math.log(1 - min(agree**bits, 1 - 1e-9)))
    return pieces, bits, max(1, math.ceil(tables / pieces))


def keys(vectors: np.ndarray, model, pieces: int, piece_bits: int) -> np.ndarray:
    """One key for each vector and table; keys of different tables differ."""
    if model is None:
        return np.zeros((len(vectors), 1), np.uint64)
    mean, projections = model
    out = []
    for r, p in enumerate(projections):
        ones = ((vectors - mean) @ p >= 0).astype(np.uint64)
        for k in range(pieces):
            part = ones[:, k * piece_bits : (k + 1) * piece_bits]
            code = (part << np.arange(part.shape[1], dtype=np.uint64)).sum(1, dtype=np.uint64)
            out.append(mixed(code + (np.uint64(r * pieces + k) << np.uint64(48)) * np.uint64(0x9E3779B1)))
    return np.stack(out, axis=1)


def usable(column: str = "embedding") -> str:
    """SQL: true for vectors that can have a cosine."""
    return (
        f"{column} IS NOT NULL AND forall({column}, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('inf'))"
        f" AND exists({column}, x -> x <> 0)"
    )


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))


def _coded(model, pieces: int, piece_bits: int, width: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            vectors = _unit(batch.column(2).flatten().to_numpy().astype(float).reshape(-1, width))
            table = keys(vectors, model, pieces, piece_bits).view(np.int64)
            at = pa.array(np.arange(len(table) + 1, dtype=np.int32) * table.shape[1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.ListArray.from_arrays(at, pa.array(table.ravel()))], names=["id", "weight", "embedding", "keys"]
            )

    return task


def _linked(cosine: float, width: int):
    """Of the vectors of each block pair: links that no earlier table has, and the least relative."""

    def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
        column = lambda name: table.column(name).to_numpy()
        group, ids, weight, second, number = (column(c) for c in ("group", "id", "weight", "second", "table"))
        vectors = _unit(table.column("embedding").combine_chunks().flatten().to_numpy().astype(float).reshape(-1, width))
        codes = table.column("keys").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
        edges = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(group)]])
        for low, high in zip(edges, edges[1:]):
            a = np.arange(low, high)
            cross = second[a].any()
            left, right = (a[~second[a]], a[second[a]]) if cross else (a, a)
            if not len(left) or not len(right) or high - low < 2:
                continue
            close = vectors[left] @ vectors[right].T >= cosine
            close &= ids[left][:, None] != ids[right][None]
            if not close.any():
                continue
            i, j = np.nonzero(close)
            label = least_linked(ids[a], left[i] - low, right[j] - low)
            fresh = np.ones(len(i), bool)
            for t in range(int(number[low])):
                fresh &= codes[left[i], t] != codes[right[j], t]
            links = np.bincount(left[i] - low, weight[right[j]] * fresh, len(a))
            if cross:
                links += np.bincount(right[j] - low, weight[left[i]] * fresh, len(a))
            some = np.unique(np.concatenate([left[i], right[j]])) - low
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[a][some]), pa.array(links[some].astype(np.int64)), pa.array(label[some])], names=["id", "links", "least"]
            )

    return lambda batches: sorted_groups(batches, "group", work)


def links(classes: DataFrame, width: int, cosine: float) -> DataFrame:
    """(id, links, least) rows for classes (id, weight, embedding) of vectors of one width."""
    spark = classes.sparkSession
    count = classes.count()
    rows = classes.select("embedding").orderBy(F.xxhash64("id"), "id").limit(FIT_ROWS + PARTNERS).toPandas()["embedding"]
    model, pieces, bits = fitted(_unit(np.stack(rows.to_list()).astype(float)), count, cosine)
    schema = "id long, weight long, embedding array<double>, keys array<long>"
    coded = stored(spark, classes.mapInArrow(_coded(model, pieces, bits, width), schema), "codes")
    spread = coded.select("id", F.posexplode("keys").alias("table", "key"))
    shared = spread.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    # a large bucket becomes blocks, and every vector goes to each pair of blocks with its own
    placed = spread.join(shared, "key").withColumn("blocks", F.expr(f"CAST(ceil(n / {BLOCK}) AS INT)"))
    placed = placed.withColumn("own", F.expr("CAST(pmod(xxhash64(id), blocks) AS INT)"))
    dealt = placed.select(
        "id", "table", "key", "own", F.explode(F.expr("IF(blocks = 1, array(0), sequence(0, blocks - 1))")).alias("other")
    ).select(
        "id", "table", (F.col("own") > F.col("other")).alias("second"),
        F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("group"),
    )
    full = dealt.join(coded, "id").repartition("group").sortWithinPartitions("group")
    return full.mapInArrow(_linked(cosine, width), "id long, links long, least long")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of ``vectors``."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    good = rows.where(usable()).where("vec_id IS NOT NULL")
    classes = stored(
        spark,
        good.distinct().groupBy("embedding").agg(F.min("vec_id").alias("id"), F.count("*").alias("weight")).select("id", "weight", "embedding"),
        "classes",
    )
    found = None
    for width in sorted(r[0] for r in classes.select(F.size("embedding")).distinct().collect()):
        part = links(classes.where(F.size("embedding") == width), width, cosine)
        found = part if found is None else found.union(part)
    if found is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    found = stored(spark, found, "links")
    joined = components(spark, found.select(F.col("id").alias("a"), F.col("least").alias("b")))
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    named = classes.join(counts, "id", "left").join(joined, "id", "left").select(
        "embedding",
        (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
    )
    linked = good.join(named, "embedding").select("vec_id", "n_links", "component_id")
    rest = rows.where(f"NOT coalesce(({usable()}) AND vec_id IS NOT NULL, false)")
    return linked.union(rest.select("vec_id", F.lit(0).cast("long"), "vec_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))
    )


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLES = {
    "op3_embedding_dedup": f"""WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= {COSINE}),
reach(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS c FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(c, vec_id) AS component_id, vec_id = coalesce(c, vec_id) AS kept
FROM embeddings e LEFT JOIN least l ON e.vec_id = l.a LEFT JOIN counts k ON e.vec_id = k.a"""
}
