"""SentencePiece ids of whole texts by a table of distinct chunks, and their decoding.

A text is normalised to one marker in front and a marker for every space. Where no piece of the
vocabulary has a marker behind another letter, no merge crosses the place before a run of markers.
So a text is cut there, each distinct chunk (markers, then letters) is segmented once by the
library, and the ids come back by position: chunks are hashed for a whole block at once, looked up
in the worker's table, and their ids gathered in text order. The table is bounded and starts anew
when it is full, so memory does not grow with the corpus, whatever its words; nothing is shuffled,
and a hot word costs one lookup for each place. A vocabulary for which this does not hold (checked
when it is loaded) gets each text from the library as a whole.

Decoding gathers the bytes of all ids' pieces for a whole block; ids whose bytes are no UTF-8, or
that are unknown or out of range, go to the library.

Defined results: a null text is an empty one, which is the end id alone. Null ids and repeated rows
are kept, each row for itself. Decoding null ids gives null. Only doc_id and text are read. A long
document is worked on in steps; a chunk that is longer than a step goes to the library in one piece.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import ClassVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.llm import textbytes as tb
from curbflow.llm.idtable import IdTable

MARKER = "▁"
STEP_BYTES = 1 << 20

_PROBE = "  a\tb　c  ﬁ Ａ é <s> "


class PieceTable:
    _shared: ClassVar[dict[str, "PieceTable"]] = {}

    @classmethod
    def shared(cls, path: str) -> "PieceTable":
        """One per worker process and file, so that later tasks find the chunks known."""
        if path not in cls._shared:
            cls._shared[path] = cls(path)
        return cls._shared[path]

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.library = SentencePieceProcessor(model_file=path)
        n = self.library.vocab_size()
        pieces = [self.library.id_to_piece(i) for i in range(n)]
        self.end = self.library.eos_id()
        self.alone = self.library.piece_to_id(MARKER)
        self.table = IdTable()
        special = [self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_byte(i) for i in range(n)]
        crossing = any(re.search(f"[^{MARKER}]{MARKER}", p) for p, s in zip(pieces, special) if not s)
        known = self.alone != self.library.unk_id()
        self.cuts = known and not crossing and self._probe()
        # the bytes of every piece, for decoding
        raw = []
        for i, p in enumerate(pieces):
            if self.library.is_byte(i):
                raw.append(bytes([int(p[3:5], 16)]))
            else:
                raw.append(b"" if special[i] else p.replace(MARKER, " ").encode())
        self.unknown = self.library.unk_id()
        self.starts_marked = np.array([not s and p.startswith(MARKER) for p, s in zip(pieces, special)])
        self.control = np.array([self.library.is_control(i) for i in range(n)])
        self.piece_at = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
        self.piece_bytes = np.frombuffer(b"".join(raw), np.uint8)

    def _probe(self) -> bool:
        """Whether text is taken as it is, with a marker in front, and cutting gives the library's ids."""
        padded = np.frombuffer(b" " + _PROBE.encode(), np.uint8)
        return self._step(padded, np.array([0]))[0].tolist() == self.library.encode(_PROBE)

    def _chunk_ids(self, chunks: list[bytes]) -> list[list[int]]:
        texts = [c[1:].decode("utf-8", "replace") for c in chunks]  # the library adds the marker in front
        return [ids if text else [self.alone] for text, ids in zip(texts, self.library.encode(texts, num_threads=1))]

    def _step(self, part: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, where each chunk's ids end, and the chunks' starts, of bytes whose documents begin with a space."""
        space = part == 32
        first = space.copy()
        first[1:] &= ~space[:-1]
        first[borders[borders < len(part)]] = True
        starts = np.flatnonzero(first)
        ends = np.append(starts[1:], len(part))
        hashes = tb.span_hash(tb.prefix_sums(part), starts, ends) | np.uint64(1)
        if self.table.full():
            self.table.reset()
        found = self.table.find(hashes)
        missing = np.flatnonzero(found < 0)
        if len(missing):
            new, at = np.unique(hashes[missing], return_index=True)
            raw = part.tobytes()
            self.table.learn(new, self._chunk_ids([raw[starts[i] : ends[i]] for i in missing[at]]))
            found[missing] = self.table.find(hashes[missing])
        ids, chunk_ends = self.table.ids(found)
        return ids, chunk_ends, starts

    def encode(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The ids of every row, in order, each with the end id."""
        if not self.cuts:
            for text in column.to_pylist():
                yield np.array([*self.library.encode(text or ""), self.end], np.uint32)
            return
        if column.null_count or pa.types.is_large_string(column.type):
            column = column.cast(pa.string()).fill_null("")
        if pc.any(pc.match_substring(column, MARKER)).as_py():
            column = pc.replace_substring(column, MARKER, " ")  # both become the marker
        data, offsets = tb.utf8(column)
        for first, last in tb.blocks(offsets, STEP_BYTES):
            own = offsets[first : last + 1] - offsets[first]
            part = data[offsets[first] : offsets[last]]
            some = own[1:] > own[:-1]  # empty texts get no marker
            padded = np.insert(part, own[:-1][some], np.uint8(32))
            borders = own + np.concatenate([[0], np.cumsum(some)])
            yield from self._block(padded, borders)

    def _block(self, part: np.ndarray, borders: np.ndarray) -> Iterator[np.ndarray]:
        held: list[np.ndarray] = []
        row = 0
        for a, b in _steps(part, borders):
            inner = tb.within(borders, a, b)
            ids, chunk_ends, starts = self._step(part[a:b], inner)
            ends = np.concatenate([[0], chunk_ends])
            begin = 0
            while row < len(borders) - 1 and borders[row + 1] <= b:
                upto = int(ends[np.searchsorted(starts, borders[row + 1] - a)])
                yield np.concatenate([*held, ids[begin:upto], np.array([self.end], np.uint32)])
                held, begin, row = [], upto, row + 1
            if begin < len(ids):
                held.append(ids[begin:].copy())
        for _ in range(row, len(borders) - 1):  # a block of empty texts alone
            yield np.array([self.end], np.uint32)

    def decode(self, ids: np.ndarray) -> str:
        """The library's text of ``ids``."""
        if len(ids) and (int(ids.min()) < 0 or int(ids.max()) >= len(self.starts_marked) or (ids == self.unknown).any() or not self.cuts):
            return self.library.decode(ids.tolist())
        begin = self.piece_at[ids]
        count = self.piece_at[ids + 1] - begin
        ends = np.cumsum(count)
        raw = self.piece_bytes[np.repeat(begin - (ends - count), count) + np.arange(int(ends[-1]) if len(ends) else 0)].tobytes()
        head = next((i for i in ids[:64] if not self.control[i]), None)
        if head is not None and self.starts_marked[head]:
            raw = raw[1:]  # the marker in front is not the text's own
        try:
            return raw.decode("utf-8")
        except UnicodeDecodeError:
            return self.library.decode(ids.tolist())


def _steps(part: np.ndarray, borders: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges of about ``STEP_BYTES`` that end before a run of spaces or at a document's border."""
    a, n = 0, len(part)
    while a < n:
        b = min(a + STEP_BYTES, n)
        if b < n:
            border = int(borders[np.searchsorted(borders, b, side="right") - 1])
            window = part[a : b + 1]
            cuts = np.flatnonzero((window[1:] == 32) & (window[:-1] != 32)) + 1
            b = max(border, a + int(cuts[-1]) if len(cuts) else a)
            if b <= a:  # one chunk all the way: on to its end
                b, end = a + STEP_BYTES, int(borders[np.searchsorted(borders, a + STEP_BYTES, side="left")])
                while b < end:
                    window = part[b - 1 : min(b + STEP_BYTES, end)]
                    cuts = np.flatnonzero((window[1:] == 32) & (window[:-1] != 32))
                    if len(cuts):
                        b += int(cuts[0])
                        break
                    b = min(b + STEP_BYTES, end)
        yield a, b
        a = b


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    at = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    flat = np.concatenate(rows).astype(np.int32) if rows else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(flat))


def encode(docs: DataFrame, model: str, decoded: bool = False) -> DataFrame:
    """(doc_id, ids) of every row, with the end id; ``decoded`` adds the ids' text as ``decoded``.

    ``model`` names a SentencePiece model that every executor can open.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = PieceTable.shared(model)
        for batch in batches:
            rows, held, first = [], 0, 0
            for row, ids in enumerate(table.encode(batch.column(1))):
                rows.append(ids)
                held += len(ids)
                if held > 1 << 18 or row == batch.num_rows - 1:
                    columns = [batch.column(0).slice(first, len(rows)), _lists(rows)]
                    if decoded:
                        columns.append(pa.array([table.decode(r) for r in rows], pa.string()))
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "decoded"][: len(columns)])
                    rows, held, first = [], 0, row + 1

    schema = "doc_id long, ids array<int>" + (", decoded string" if decoded else "")
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(task, schema)


def decode(ids: str | Column, model: str) -> Column:
    """The text of a column of id lists."""

    @F.arrow_udf("string")
    def decoded(lists: pa.Array) -> pa.Array:
        table = PieceTable.shared(model)
        return pa.array([None if r is None else table.decode(np.array(r, np.int64)) for r in lists.to_pylist()], pa.string())

    return decoded(ids)


def op11_piece_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = encode(docs, public_tokenizers.path("piece_bpe_32k.model"), decoded=True)
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
