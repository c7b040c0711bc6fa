"""Product codes of vectors, with nearest entries found by slice-and-intersect bitmasks.

Vectors are cut into ``PARTS`` parts, and each part position has a codebook of at most ``ENTRIES``
entries, which is fitted by rounds of assigning every part to its nearest entry and moving each
entry to its parts' mean, all in integers.

For every dimension of a codebook the entries' coordinates are sorted, and behind each sorted
coordinate stands a mask (``uint64`` words, one bit for each entry) of all entries up to it. A part's
search starts from a radius that an entry is known to lie in: the least distance to a few entries
that are close in some dimension. Two binary searches a dimension give the slice of coordinates
within the radius; the masks at its ends, one without the other, are the entries in the slice, and
the AND over all dimensions leaves those within the radius in every dimension. No entry that is
nearer, or as near, can be missing, so the candidates are exact; their squared distances decide,
ties to the lower index.

Each round is one pass over the vectors: tasks add up their own parts by entry, reducers add the
tasks' sums, and at most ``PARTS`` x ``ENTRIES`` sums reach the driver. Codebooks of that size go to
the tasks. Labels that hold many rows are added up before the shuffle, and joined back salted.

Defined results: a vector that is null or empty, or has a null or non-finite component, is left out.
So is one of another length than the vector with the smallest id. Components stand as
floor(1024 x), held within ±2^25 so that all sums fit 64 bits. Lengths that ``PARTS`` does not divide
give first parts that are one longer. Null ids come last where entries are chosen; of rows with one
id the lesser vector comes first. Repeated rows are coded each for itself, and weigh so in the means. Null labels form
one group. An empty table gives no rows. Only vec_id, embedding and label are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.llm.groups import stored

PARTS, ENTRIES, ROUNDS = 4, 256, 4
SCALE = 1024
MOST = 1 << 25  # integers lie within this
PROBES = 4  # dimensions whose closest entry gives a first radius
BLOCK = 512  # parts that are searched at once
SALT = 16


class Codebook:
    """The entries of one part position (rows of integers), ready for searches."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        n, width = entries.shape
        self.words = -(-n // 64)
        self.order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = np.take_along_axis(entries, self.order, axis=0)
        bit = np.zeros((n, self.words), np.uint64)
        bit[np.arange(n), np.arange(n) // 64] = np.uint64(1) << (np.arange(n) % 64).astype(np.uint64)
        # masks[d, k]: the entries with the k smallest coordinates of dimension d
        self.all = np.bitwise_or.reduce(bit, axis=0)
        self.masks = np.zeros((width, n + 1, self.words), np.uint64)
        for d in range(width):
            self.masks[d, 1:] = np.bitwise_or.accumulate(bit[self.order[:, d]], axis=0)
        # probed: the dimensions in which the entries differ most
        spread = self.sorted[-1] - self.sorted[0] if n else np.zeros(width, np.int64)
        self.probes = np.argsort(-spread, kind="stable")[:PROBES]

    def radius2(self, parts: np.ndarray) -> np.ndarray:
        """A squared distance within which each part has an entry."""
        best = np.zeros(len(parts), np.int64) if not len(self.probes) else None  # a part without dimensions
        for d in self.probes:
            at = np.searchsorted(self.sorted[:, d], parts[:, d])
            for near in (np.maximum(at - 1, 0), np.minimum(at, len(self.entries) - 1)):
                apart = parts - self.entries[self.order[near, d]]
                square = (apart * apart).sum(1)
                best = square if best is None else np.minimum(best, square)
        return best

    def candidates(self, parts: np.ndarray, square: np.ndarray) -> np.ndarray:
        """Masks of the entries within the radius of each part in every dimension."""
        radius = np.ceil(np.sqrt(square.astype(float))).astype(np.int64) + 1  # never less than the root
        mask = np.tile(self.all, (len(parts), 1))
        for d in range(parts.shape[1]):
            low = np.searchsorted(self.sorted[:, d], parts[:, d] - radius, side="left")
            high = np.searchsorted(self.sorted[:, d], parts[:, d] + radius, side="right")
            mask &= self.masks[d, high] & ~self.masks[d, low]
        return mask

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each part."""
        entry, error = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        for k in range(0, len(parts), BLOCK):
            own = parts[k : k + BLOCK]
            mask = self.candidates(own, self.radius2(own))
            bits = np.unpackbits(mask.astype("<u8").view(np.uint8).reshape(len(own), -1), axis=1, bitorder="little")
            row, candidate = np.nonzero(bits)
            apart = own[row] - self.entries[candidate]
            square = np.einsum("ij,ij->i", apart, apart)
            first = np.flatnonzero(np.append(True, np.diff(row) != 0))
            least = np.minimum.reduceat(square, first)
            is_least = square == np.repeat(least, np.diff(np.append(first, len(row))))
            # candidates ascend, so the first of equals has the lowest index
            at = np.flatnonzero(is_least)
            at = at[np.append(True, np.diff(row[at]) != 0)]
            entry[k : k + BLOCK], error[k : k + BLOCK] = candidate[at], least
        return entry, error


def bounds(width: int) -> list[tuple[int, int]]:
    """Where each part begins and ends."""
    sizes = [width // PARTS + (p < width % PARTS) for p in range(PARTS)]
    ends = np.cumsum(sizes)
    return [(int(e) - s, int(e)) for s, e in zip(sizes, ends)]


def usable(column: str = "embedding") -> str:
    """SQL: true for vectors that are coded."""
    return f"coalesce(size({column}) > 0 AND forall({column}, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('inf')), false)"


def integers(batch_column: pa.Array, width: int) -> np.ndarray:
    """Rows of floor(1024 x)."""
    flat = batch_column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return np.clip(np.floor(np.clip(flat, -MOST, MOST) * SCALE), -MOST, MOST).astype(np.int64).reshape(-1, width)


def _sums(books: list[np.ndarray], width: int):
    """(part, entry, sums, count) of a task's own vectors."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts, search = bounds(width), [Codebook(b) for b in books]
        sums = [np.zeros(b.shape, np.int64) for b in books]
        counts = np.zeros((PARTS, ENTRIES), np.int64)
        for batch in batches:
            vectors = integers(batch.column(0), width)
            for p, (a, b) in enumerate(cuts):
                entry, _ = search[p].nearest(vectors[:, a:b])
                np.add.at(sums[p], entry, vectors[:, a:b])
                counts[p] += np.bincount(entry, minlength=ENTRIES)
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)),
                pa.array([sums[p][e] for p, e in zip(part, entry)], pa.list_(pa.int64())), pa.array(counts[part, entry]),
            ],
            names=["part", "entry", "sums", "n"],
        )

    return task


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up the tasks' sums of each (part, entry) of this partition; sums as decimal text, exact at any size."""
    total: dict[tuple[int, int], list] = {}
    for batch in batches:
        for part, entry, sums, n in zip(*(c.to_pylist() for c in batch.columns)):
            own = total.setdefault((part, entry), [[0] * len(sums), 0])
            own[0] = [a + b for a, b in zip(own[0], sums)]
            own[1] += n
    rows = [(p, e, [str(v) for v in sums], n) for (p, e), (sums, n) in total.items()]
    kinds = [pa.int32(), pa.int32(), pa.list_(pa.string()), pa.int64()]
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["part", "entry", "sums", "n"])


def moved(vectors: DataFrame, books: list[np.ndarray], width: int) -> list[np.ndarray]:
    """The codebooks after one round; entries without parts stay."""
    sums = vectors.select("embedding").mapInArrow(_sums(books, width), "part int, entry int, sums array<long>, n long")
    added = sums.repartition("part", "entry").mapInArrow(_added, "part int, entry int, sums array<string>, n long")
    out = [b.copy() for b in books]
    for r in added.collect():  # at most PARTS x ENTRIES rows
        out[r["part"]][r["entry"]] = [int(s) // r["n"] for s in r["sums"]]
    return out


def first_entries(vectors: DataFrame, width: int) -> list[np.ndarray]:
    rows = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(ENTRIES).select("embedding").collect()
    table = integers(pa.array([r[0] for r in rows], pa.list_(pa.float64())), width)
    return [table[:, a:b].copy() for a, b in bounds(width)]


def digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(v) for book in books for v in book.ravel().tolist()).encode()).hexdigest()


def fit(vectors: DataFrame, width: int, rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebooks of vectors of one width after so many rounds."""
    books = first_entries(vectors, width)
    for _ in range(rounds):
        books = moved(vectors, books, width)
    return books


def coded(vectors: DataFrame, books: list[np.ndarray], width: int) -> DataFrame:
    """(vec_id, label, code, error) of every vector."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts, search = bounds(width), [Codebook(b) for b in books]
        for batch in batches:
            table = integers(batch.column(2), width)
            found = [search[p].nearest(table[:, a:b]) for p, (a, b) in enumerate(cuts)]
            codes = np.stack([entry for entry, _ in found], axis=1).astype(np.uint8)
            errors = np.sum([error for _, error in found], axis=0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array(errors)],
                names=["vec_id", "label", "code", "error"],
            )

    schema = "vec_id long, label string, code string, error long"
    return vectors.select("vec_id", "label", "embedding").mapInArrow(task, schema)


def compress(vectors: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, label, code, error) of all usable vectors, and the codebooks."""
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("embedding")
    ).where(usable())
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").select(F.size("embedding")).first()
    width = first[0] if first else 0
    rows = rows.where(F.size("embedding") == width)
    if not width:
        return rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), []
    books = fit(rows, width, rounds)
    return stored(spark, coded(rows, books, width), "codes"), books


def with_label_error(codes: DataFrame) -> DataFrame:
    """Adds the sum of ``error`` over each row's label; a label's rows are dealt to ``SALT`` tasks."""
    sums = codes.groupBy("label").agg(F.sum("error").alias("label_error"))
    sums = sums.select(F.col("label").alias("of"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("to"))
    salt = F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALT)).cast("int")
    joined = codes.withColumn("salt", salt).join(sums, F.col("label").eqNullSafe(F.col("of")) & (F.col("salt") == F.col("to")))
    return joined.drop("salt", "of", "to")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return with_label_error(codes).select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _oracle() -> str:
    """All distances to all entries, a materialised step for each assignment and each codebook.

    Squared distances come from inner products, exact in doubles for integers of this size.
    """
    steps = [
        """kept AS MATERIALIZED (SELECT vec_id, label, embedding AS e FROM embeddings
  WHERE len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0)""",
        f"""parts AS MATERIALIZED (SELECT vec_id, label, p, [floor({SCALE}::DOUBLE * x) FOR x IN
  e[p * (len(e) // {PARTS}) + 1 : (p + 1) * (len(e) // {PARTS})]] AS v FROM kept, range({PARTS}) r(p))""",
        f"""b0 AS MATERIALIZED (SELECT p, n AS c, v FROM
  (SELECT p, v, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS n FROM parts) WHERE n < {ENTRIES})""",
    ]
    for k in range(ROUNDS + 1):
        steps.append(f"""a{k} AS MATERIALIZED (SELECT vec_id, label, p, first(v) AS v,
  arg_min(c, d * {ENTRIES} + c) AS c, min(d) AS d FROM (SELECT a.vec_id, a.label, a.p, a.v, b.c,
    list_inner_product(a.v, a.v) - 2 * list_inner_product(a.v, b.v) + list_inner_product(b.v, b.v) AS d
  FROM parts a JOIN b{k} b ON a.p = b.p) GROUP BY vec_id, label, p)""")
        if k < ROUNDS:
            steps.append(f"""b{k + 1} AS MATERIALIZED (SELECT p, c, coalesce(m.v, b.v) AS v FROM b{k} b LEFT JOIN
  (SELECT p, c, list(floor(s / n) ORDER BY i) AS v FROM (SELECT p, c, i, sum(x) AS s, count(*) AS n
    FROM (SELECT p, c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{k}) GROUP BY p, c, i) GROUP BY p, c) m USING (p, c))""")
    return f"""WITH {", ".join(steps)},
books AS (SELECT sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY p, c, i)) AS h
  FROM (SELECT p, c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM b{ROUNDS})),
codes AS (SELECT vec_id, label, string_agg(printf('%02x', c), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM a{ROUNDS} GROUP BY vec_id, label)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM codes, books"""


ORACLES = {"op13_vector_codes": _oracle()}
