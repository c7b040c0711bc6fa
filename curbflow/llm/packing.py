"""Packing of token sequences by the online sum-of-squares rule.

Documents become token ids, get an end id, and are cut into windows of ``capacity`` ids. Full
windows leave at once. What remains of a document (shorter than a window) is placed whole: among
the fill levels of the open windows it takes the level h that minimises the sum over all levels
of squared counts N of open windows, with a new window as level 0 and a filled window counting
nothing. The counts lie in a level array.
When a task's input ends, the windows that are still open are closed by cutting their pieces anew
one after the other, so a task leaves at most one window that is not full. That last one is
padded up to ``capacity``, or kept as it is where its length is a power of two.

Every Spark partition packs its own documents: there is no shuffle, no state outside a task, and
a lost task gives the same pieces again, as sequence ids are partition number and count.

Defined results: a null text is an empty document, which is one end id. A null doc_id stays null.
Repeated rows are packed each for itself. An empty table gives no pieces. Other columns are not
read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.llm.tokens import WordBpe
from curbflow.llm.workers import lean

CAPACITY = 2048
END_ID = 1

SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class LevelPacker:
    """Open windows by fill level. ``add`` returns the windows that became full."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.counts = np.zeros(capacity + 1, np.int64)
        self.open: list[list[list]] = [[] for _ in range(capacity + 1)]

    def place(self, size: int) -> int:
        """The level to put a piece of ``size`` on; level 0 is a new window."""
        # moving a window from h to h + size adds 2 (N(h + size) - N(h)) + 2 to the sum of squares
        counts, last = self.counts, self.capacity - size
        cost = 2 * (counts[size : size + last + 1] - counts[: last + 1]) + 2
        cost[last] = 1 - 2 * counts[last]  # a full window counts nothing
        usable = counts[: last + 1] > 0
        usable[0] = True
        cost[0] = 2 * counts[size] + 1
        cost = np.where(usable, cost, np.iinfo(np.int64).max)
        # among equal costs the fullest window
        return last - int(np.argmin(cost[::-1]))

    def add(self, piece, size: int) -> list | None:
        level = self.place(size)
        window = [] if level == 0 else self.open[level].pop()
        if level:
            self.counts[level] -= 1
        window.append(piece)
        if level + size == self.capacity:
            return window
        self.open[level + size].append(window)
        self.counts[level + size] += 1
        return None

    def rest(self) -> Iterator[list]:
        """All open windows, the fullest first."""
        for level in range(self.capacity, 0, -1):
            yield from self.open[level]


def pack_task(documents: Iterator[tuple], capacity: int, partition: int) -> Iterator[tuple]:
    """``documents``: (doc_id, ids as uint32 array). Yields rows of ``SCHEMA``."""
    packer, count = LevelPacker(capacity), 0

    def closed(window) -> Iterator[tuple]:
        nonlocal count
        offset, sequence = 0, (partition << 40) + count
        count += 1
        for doc_id, start, ids, total in window:
            yield doc_id, start, len(ids), ids.tobytes(), total, sequence, offset
            offset += len(ids)

    for doc_id, ids in documents:
        total = len(ids)
        whole = total - total % capacity
        for start in range(0, whole, capacity):
            yield from closed([(doc_id, start, ids[start : start + capacity], total)])
        if whole < total:
            full = packer.add((doc_id, whole, ids[whole:].copy(), total), total - whole)
            if full:
                yield from closed(full)
    window, room = [], capacity
    for old in packer.rest():
        for doc_id, start, ids, total in old:
            while len(ids):
                part = ids[:room]
                window.append((doc_id, start, part, total))
                start, ids, room = start + len(part), ids[room:], room - len(part)
                if room == 0:
                    yield from closed(window)
                    window, room = [], capacity
    if window:
        yield from closed(window)


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents: the ids of a piece (little-endian unsigned 32-bit) and its place.

    ``tokenizer`` names a vocabulary file that every executor can open.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = WordBpe.shared(tokenizer)

        def documents():
            for batch in batches:
                names = batch.column(0).to_pylist()
                for row, ids in bpe.encode(batch.column(1), end_id):
                    yield names[row], ids

        rows: list[tuple] = []
        held = 0
        for row in pack_task(documents(), capacity, TaskContext.get().partitionId()):
            rows.append(row)
            held += row[2]
            if held > 1 << 20:
                yield _batch(rows)
                rows, held = [], 0
        if rows:
            yield _batch(rows)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(lean(task, WordBpe.forget), SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def op5_pack_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    pieces = pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
