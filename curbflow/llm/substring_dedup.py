"""Removal of repeated 50-byte strings with sharded suffix arrays built by induced sorting.

A byte goes when some string of ``LENGTH`` bytes covers it that also starts in a document with a
smaller id. Equal strings must meet in one shard, without all suffixes travelling:

- Every string of ``LENGTH`` bytes has an anchor, the leftmost of its ``GRAM``-byte grams with the
  least hash. Equal strings have equal anchors, so anchors decide the shard. A document sends one
  row for each run of strings with the same anchor: the gram's hash, a fingerprint of the run's
  text, its place, and short fingerprints of the bytes around the gram, one for each quarter of the
  places that the gram can have in a string. Rows travel packed, and so do the spans that parts decide: each goes
  to the bucket of its document, where those of all parts become few long ones before they are written.
- Where all rows of an anchor have the same text, the smallest id keeps it and all others lose it.
- Where texts differ, and bytes beside the gram agree so that a whole string may be shared, those
  strings' text goes to the shard, once for each distinct text, with the smallest ids. There a
  suffix array is induced, permuted common prefixes are computed, and runs of suffixes that share
  ``LENGTH`` bytes are the groups of equal strings; each group's smallest id keeps its string.

Hot texts are aggregated before the shuffle: of equal rows within a block, only those of the
smallest id go on, since the others have a smaller document already. A hot anchor, one that a
passage of many documents brings along, would still gather a different text from each of them at
the passage's edges. Anchors that more than one in ``HOT_SHARE`` documents of a bounded sample hold
are hot; their runs are cut into single strings, which are dealt by the hash of the whole string.
The sample decides where strings meet, never what is removed.

Defined results: a null text is empty. A null id counts as larger than all others. Rows with the
same id are one document, as far as who keeps a string goes: none of them loses to another.
Rows with one id but other texts keep their own spans. An empty table gives no rows. Other columns
ride along, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbflow.llm import textbytes as tb
from curbflow.llm.groups import sorted_groups, stored
from curbflow.llm.suffixes import induced, permuted_lcp
from curbflow.session import setting

LENGTH, GRAM = 50, 16
BLOCK_BYTES = 2 << 20
SHARD_BYTES = 1 << 19  # the arrays of a shard should stay within a core's caches
# A sample of about so many documents finds the hot anchors: at most HOT_SHARE times the anchors of a
# mean document, which is what the driver receives.
SAMPLE_ROWS = 8192
HOT_SHARE, HOT_ROWS = 256, 8
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
NO_ID = np.iinfo(np.int64).max  # stands for a null id

DEAL_ROWS = 1 << 18  # so many anchors of a task are dealt at once, so that a part's rows come in long stretches

# An anchor, with the run of strings that it stands for: the lower half of the gram's hash, a fingerprint of the
# run's text, the document's number, the run's first byte, its strings, and 48 bits for the bytes around the gram:
# the gram's place in the run in the highest eight, and for each quarter of the gram's places in a string ten bits,
# zero where no string of the run has it there.
_RUN = np.dtype([("hash", "<u4"), ("text", "<u8"), ("doc", "<u4"), ("at", "<u4"), ("count", "u1"), ("around", "<u8")])
# Of a packed anchor what no coding makes shorter; the rest travels column by column beside it.
_ANCHOR = np.dtype([("hash", "<u4"), ("text", "<u8")])
QUARTERS, _SIDE_BITS, _GRAM_AT = 4, 10, np.uint64(40)
_SIDE = np.uint64((1 << _SIDE_BITS) - 1)
_DOC = np.dtype([("id", "<i8"), ("key", "<i4")])
_SPAN = np.dtype([("start", "<u4"), ("size", "<u4")])
_PLACE_BITS = np.uint64(26)
_PLACE = (np.uint64(1) << _PLACE_BITS) - np.uint64(1)


def _least(values: np.ndarray, windows: int) -> np.ndarray:
    """Sliding minimum, by doubling."""
    n, least, size = len(values) - windows + 1, values, 1
    while size * 2 <= windows:
        least = np.minimum(least[: len(least) - size], least[size:])
        size *= 2
    return np.minimum(least[:n], least[windows - size : windows - size + n])


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(anchors, upper halves of their hashes) of a block of documents, in order of place.

    ``doc`` is the document's row in the block, and ``at`` counts from the document's start.
    """
    windows, n = length - gram + 1, len(data) - length + 1
    if n <= 0:
        return np.zeros(0, _RUN), np.zeros(0, np.uint64)
    sums = tb.prefix_sums(data)
    starts = np.arange(len(data) - gram + 1)
    hashes = tb.span_hash(sums, starts, starts + gram)
    # the place in the lowest bits makes the leftmost of equal hashes the least
    place = (_least((hashes & ~_PLACE) | starts.astype(np.uint64), windows) & _PLACE).astype(np.int64)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    valid = doc[:n] == doc[length - 1 :]  # strings within one document
    change = np.append(True, (place[1:] != place[:-1]) | (doc[1:n] != doc[: n - 1]))
    first = np.flatnonzero(valid & (change | ~np.append(False, valid[:-1])))
    last = np.flatnonzero(valid & np.append(change[1:] | ~valid[1:], True)) + 1
    out = np.zeros(len(first), _RUN)
    m, own = place[first], doc[first]
    out["hash"], out["doc"], out["at"], out["count"] = hashes[m] & np.uint64(0xFFFFFFFF), own, first - offsets[own], last - first
    out["text"] = tb.span_hash(sums, first, last + length - 1)
    around = (m - first).astype(np.uint64) << _GRAM_AT
    has = _has(m - first, last - first, windows)
    for q, (low, high) in enumerate(_quarters(windows)):
        # strings with the gram at low to high share these bytes around it
        own = m[has[:, q]]
        shared = tb.span_hash(sums, own - low, own + length - high)
        around[has[:, q]] |= _side(shared, q)
    out["around"] = around
    return out, hashes[m] >> np.uint64(32)


def _quarters(windows: int) -> list[tuple[int, int]]:
    """(first, last) of the gram's places in a string, by quarter."""
    cuts = [windows * q // QUARTERS for q in range(QUARTERS + 1)]
    return [(a, b - 1) for a, b in zip(cuts, cuts[1:])]


def _has(gram_at: np.ndarray, count: np.ndarray, windows: int) -> np.ndarray:
    """By run and quarter: has a string of the run the gram there?"""
    low, high = np.array(_quarters(windows)).T
    return (gram_at[:, None] >= low) & ((gram_at - count)[:, None] < high)


def _side(hashes: np.ndarray, quarter: np.ndarray | int) -> np.ndarray:
    """The fingerprints of a quarter at their bits."""
    short = np.maximum(hashes >> np.uint64(64 - _SIDE_BITS), np.uint64(1))
    return short << np.uint64(_SIDE_BITS * quarter) if np.isscalar(quarter) else short << (quarter * _SIDE_BITS).astype(np.uint64)


def _chunks(offsets: np.ndarray, length: int) -> Iterator[tuple[int, int, int, int]]:
    """(first row, last row, first byte, last byte); a very long document comes in overlapping parts."""
    for first, last in tb.blocks(offsets, BLOCK_BYTES):
        low, high = int(offsets[first]), int(offsets[last])
        step = 8 * BLOCK_BYTES
        for begin in range(low, max(high - length + 1, low + 1), step):
            yield first, last, begin, min(high, begin + step + length - 1)


def _sampled(length: int):
    """(hash, documents) of the anchors in each block of a sample."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tb.utf8(batch.column(0))
            for first, last, begin, end in _chunks(offsets, length):
                found, upper = anchors(data[begin:end], np.clip(offsets[first : last + 1], begin, end) - begin, length)
                full = (upper << np.uint64(32)) | found["hash"]
                order = np.lexsort((found["doc"], full))
                full, doc = full[order], found["doc"][order]
                once = np.append(True, (full[1:] != full[:-1]) | (doc[1:] != doc[:-1]))[: len(full)]
                hashes, docs = np.unique(full[once], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(docs)], names=["hash", "docs"])

    return task


def hot_anchors(docs: DataFrame, length: int = LENGTH) -> np.ndarray:
    """The hashes of anchors that many documents hold, ascending."""
    n = docs.count()
    step = max(1, n // SAMPLE_ROWS)
    sample = docs.where(F.pmod(F.xxhash64("id", "key"), F.lit(step)) == 0).select("text")
    counted = sample.mapInArrow(_sampled(length), "hash long, docs long").groupBy("hash").agg(F.sum("docs").alias("docs"))
    least = max(HOT_ROWS, n // step // HOT_SHARE)
    hashes = [r["hash"] for r in counted.where(F.col("docs") > least).select("hash").collect()]
    return np.sort(np.array(hashes, np.int64).view(np.uint64))


def _cut(rows: np.ndarray, first: np.ndarray, sums: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The strings of rows, each as a row of its own keyed by the whole string; and the upper halves
    of the strings' hashes. ``first`` are the rows' first bytes in the block."""
    count = rows["count"].astype(np.int64)
    inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    start = np.repeat(first, count) + inner
    text = tb.span_hash(sums, start, start + length)
    out = np.repeat(rows, count)
    # together with the text's fingerprint this still tells the anchor
    out["hash"] ^= (text & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    out["text"], out["at"], out["count"] = text, out["at"] + inner.astype(np.uint32), 1
    gram_at = (out["around"] >> _GRAM_AT).astype(np.int64) - inner
    quarter = np.searchsorted([low for low, _ in _quarters(length - GRAM + 1)], gram_at, side="right") - 1
    out["around"] = (gram_at.astype(np.uint64) << _GRAM_AT) | _side(text, quarter)
    return out, text >> np.uint64(32)


def _map(parts: int, length: int, hot: np.ndarray):
    """Anchors of all documents by part, hot ones string by string; and spans that a document of the
    same block already decides."""

    def settled(found: np.ndarray, upper: np.ndarray, first: np.ndarray, docs: np.ndarray, rows: list) -> tuple:
        order = np.argsort(found["text"])
        ranked = found["text"][order]
        same = ranked[1:] == ranked[:-1]
        order = order[np.append(same, False) | np.append(False, same)] if len(order) else order
        ids = docs["id"][found["doc"][order]]
        by = np.lexsort((ids, found["text"][order], found["hash"][order]))
        order, ids = order[by], ids[by]
        later = order[_later(found[order], ids)]
        if len(later):
            own, start, end = _union(docs[found["doc"][later]], *_spans(found[later], length))
            # decided spans go to any part, by their document
            rows.append((int(docs["key"][0]) % parts, True, *_packed_spans(own, start, end)))
        stays = np.ones(len(found), bool)
        stays[later] = False
        return found[stays], upper[stays], first[stays]

    def blocks(batches: Iterator[pa.RecordBatch], rows: list) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(anchors in order of document, their parts, documents) of each block."""
        for batch in batches:
            data, offsets = tb.utf8(batch.column(2))
            ids = batch.column(0).fill_null(NO_ID).to_numpy()
            keys = batch.column(1).to_numpy()
            for first, last, begin, end in _chunks(offsets, length):
                inner = np.clip(offsets[first : last + 1], begin, end) - begin
                found, upper = anchors(data[begin:end], inner, length)
                if not len(found):
                    continue
                own, number = np.unique(found["doc"], return_inverse=True)
                start = inner[found["doc"]] + found["at"]
                if end - begin > BLOCK_BYTES:  # a part of one long document
                    found["at"] += np.uint32(begin - offsets[first])
                found["doc"] = number
                docs = np.zeros(len(own), _DOC)
                docs["id"], docs["key"] = ids[first + own], keys[first + own]
                found, upper, start = settled(found, upper, start, docs, rows)
                full = (upper << np.uint64(32)) | found["hash"]
                common = np.isin(full, hot)
                if common.any():
                    strings, high = _cut(found[common], start[common], tb.prefix_sums(data[begin:end]), length)
                    strings, high, _ = settled(strings, high, high, docs, rows)
                    found, upper = np.concatenate([found[~common], strings]), np.concatenate([upper[~common], high])
                    order = np.argsort(found["doc"], kind="stable")
                    found, upper = found[order], upper[order]
                yield found, upper % np.uint64(parts), docs

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held, size = [], [], 0
        for block in blocks(batches, rows):
            held.append(block)
            size += len(block[0])
            if size >= DEAL_ROWS:
                yield _dealt(held, rows, length)
                held, size = [], 0
                rows.clear()
        if held or rows:
            yield _dealt(held, rows, length)

    return task


def _dealt(held: list, rows: list, length: int) -> pa.RecordBatch:
    """The rows of some blocks, and others besides, as they travel: (part, decided, docs, body)."""
    if held:
        before = np.cumsum([0, *(len(docs) for _, _, docs in held)])
        for (found, _, _), n in zip(held, before):
            found["doc"] += np.uint32(n)
        found, part, docs = (np.concatenate(x) for x in zip(*held))
        # in order of part, then of document
        order = np.sort((part << np.uint64(32)) | np.arange(len(part), dtype=np.uint64))
        part, order = (order >> np.uint64(32)).astype(np.int64), (order & np.uint64(0xFFFFFFFF)).astype(np.int64)
        rows = rows + [(p, False, *packed) for p, *packed in _packed(docs, found[order], part, length)]
    kinds = [pa.int32(), pa.bool_(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds], names=["part", "decided", "docs", "body"])


def _later(rows: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Of rows sorted by hash, text and id: those whose text a smaller id has, too."""
    new = np.append(True, (rows["text"][1:] != rows["text"][:-1]) | (rows["hash"][1:] != rows["hash"][:-1]))[: len(rows)]
    least = ids[np.flatnonzero(new)][np.cumsum(new) - 1]
    return ids > least


def _spans(rows: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the bytes that the strings of each row cover."""
    start = rows["at"].astype(np.int64)
    return start, start + rows["count"] + (length - 1)


def _new(own: np.ndarray) -> np.ndarray:
    """True where a row's document is not that of the row before."""
    return np.append(True, (own["id"][1:] != own["id"][:-1]) | (own["key"][1:] != own["key"][:-1]))[: len(own)]


def _union(own: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The spans of each document, in order, those that overlap or touch as one."""
    order = np.lexsort((start, own["key"], own["id"]))
    own, start, end = own[order], start[order], end[order]
    doc = np.cumsum(_new(own)) << 32
    reach = np.maximum.accumulate(doc + end)
    first = np.append(True, (doc + start)[1:] > reach[:-1])[: len(own)]
    last = np.append(first[1:], True)[: len(own)]
    return own[first], start[first], (reach - doc)[last]


def _planes(values: np.ndarray) -> bytes:
    """The first bytes of all values, then the second ones and so on, which compresses better."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.dtype.itemsize).T.tobytes()


def _of_planes(raw: np.ndarray, kind: np.dtype) -> np.ndarray:
    return np.ascontiguousarray(raw.reshape(kind.itemsize, -1).T).view(kind)[:, 0]


def _packed(docs: np.ndarray, rows: np.ndarray, group: np.ndarray, length: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(group, documents and places, anchors) for each group of rows sorted by group and document.

    Column by column: one bit where a document begins, the first byte's place, the strings, the gram's
    place, the fingerprints that a run has (their lowest eight bits, then the two others), the documents.
    """
    edges = np.flatnonzero(np.append(True, group[1:] != group[:-1])[: len(group)])
    new = np.append(True, rows["doc"][1:] != rows["doc"][:-1])[: len(rows)]
    new[edges] = True
    own, before = docs[rows["doc"][new]], np.append(0, np.cumsum(new))
    body = np.zeros(len(rows), _ANCHOR)
    body["hash"], body["text"] = rows["hash"], rows["text"]
    at, count, around = rows["at"].copy(), rows["count"].copy(), rows["around"]
    gram_at = (around >> _GRAM_AT).astype(np.uint8)
    has = _has(gram_at.astype(np.int64), count.astype(np.int64), length - GRAM + 1)
    shift = np.arange(QUARTERS, dtype=np.uint64) * np.uint64(_SIDE_BITS)
    side = ((around[:, None] >> shift) & _SIDE)[has].astype(np.uint16)
    sides = np.append(0, np.cumsum(has.sum(axis=1)))
    low, bit8, bit9 = side.astype(np.uint8), (side & 256) > 0, (side & 512) > 0
    for a, b in zip(edges.tolist(), np.append(edges[1:], len(rows)).tolist()):
        i, j = sides[a], sides[b]
        columns = np.packbits(new[a:b]), at[a:b], count[a:b], gram_at[a:b], low[i:j], np.packbits(bit8[i:j]), np.packbits(bit9[i:j]), own[before[a] : before[b]]
        yield int(group[a]), b"".join(map(_planes, columns)), body[a:b].tobytes()


def _unpacked(places: bytes, anchors: bytes, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, their documents) of a packed group."""
    body, raw, done = np.frombuffer(anchors, _ANCHOR), np.frombuffer(places, np.uint8), 0
    n = len(body)

    def take(size: int) -> np.ndarray:
        nonlocal done
        done += size
        return raw[done - size : done]

    def bits(size: int) -> np.ndarray:
        return np.unpackbits(take((size + 7) // 8), count=size)

    rows = np.zeros(n, _RUN)
    rows["hash"], rows["text"] = body["hash"], body["text"]
    new = bits(n)
    rows["at"], rows["count"] = _of_planes(take(4 * n), np.dtype("<u4")), take(n)
    gram_at = take(n)
    has = _has(gram_at.astype(np.int64), rows["count"].astype(np.int64), length - GRAM + 1)
    size = int(has.sum())
    side = np.zeros(has.shape, np.uint64)
    side[has] = take(size) + (bits(size).astype(np.uint64) << np.uint64(8)) + (bits(size).astype(np.uint64) << np.uint64(9))
    around = gram_at.astype(np.uint64) << _GRAM_AT
    for q in range(QUARTERS):
        around |= side[:, q] << np.uint64(_SIDE_BITS * q)
    rows["around"] = around
    return rows, _of_planes(raw[done:], _DOC)[np.cumsum(new, dtype=np.int64) - 1]


def _packed_spans(own: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[bytes, bytes]:
    """(documents, spans) of rows in order of document."""
    new = _new(own)
    spans = np.zeros(len(own), _SPAN)
    spans["start"], spans["size"] = start, end - start
    return _planes(own[new]), _planes(spans) + np.packbits(new).tobytes()


def _unpacked_spans(docs: bytes, body: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, end) of packed spans."""
    n = len(body) * 8 // (8 * _SPAN.itemsize + 1)
    raw = np.frombuffer(body, np.uint8)
    spans = _of_planes(raw[: n * _SPAN.itemsize], _SPAN)
    new = np.unpackbits(raw[n * _SPAN.itemsize :], count=n)
    own = _of_planes(np.frombuffer(docs, np.uint8), _DOC)[np.cumsum(new, dtype=np.int64) - 1]
    start = spans["start"].astype(np.int64)
    return own, start, start + spans["size"]


def _reduce(length: int, given=None):
    """Per part: spans that are decided by equal texts, and requests for texts that must be compared,
    as ``given`` (by default ``_by_document``) lays them out."""
    given = given or _by_document

    def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
        part, decided = table.column("part").to_numpy(), table.column("decided").to_numpy()
        docs, body = table.column("docs").to_pylist(), table.column("body").to_pylist()
        for i in np.flatnonzero(decided):
            own, start, end = _unpacked_spans(docs[i], body[i])
            yield from given(own, start, end, np.zeros(len(own), np.int64), False)
        for p in np.unique(part[~decided]):
            at = np.flatnonzero((part == p) & ~decided)
            # only hashes of several rows matter
            hashes = np.concatenate([np.frombuffer(body[i], _ANCHOR)["hash"] for i in at])
            packed = np.sort((hashes.astype(np.uint64) << np.uint64(32)) | np.arange(len(hashes), dtype=np.uint64))
            key = packed >> np.uint64(32)
            same = key[1:] == key[:-1]
            several = np.zeros(len(hashes), bool)
            several[(packed[np.append(same, False) | np.append(False, same)] & np.uint64(0xFFFFFFFF)).astype(np.int64)] = True
            kept, done = [], 0
            for i in at:
                rows, own = _unpacked(docs[i], body[i], length)
                use = several[done : done + len(rows)]
                kept.append((rows[use], own[use]))
                done += len(rows)
            rows, own = (np.concatenate(x) for x in zip(*kept))
            del hashes, packed, key, same, several, kept
            order = np.lexsort((own["id"], rows["text"], rows["hash"]))
            rows, own = rows[order], own[order]
            later = _later(rows, own["id"])
            yield from given(own[later], *_spans(rows[later], length), np.zeros(int(later.sum()), np.int64), False)
            rows, own = rows[~later], own[~later]
            first, last = _undecided(rows, length)
            open_ = last >= 0
            rows, own, first, last = rows[open_], own[open_], first[open_], last[open_]
            shard = (np.int64(p) << 32) | rows["hash"].astype(np.int64)
            yield from given(own, rows["at"] + first, rows["at"] + last + length, shard, True)

    return lambda batches: sorted_groups(batches, "part", work)


_HOME_SCHEMA = "bucket int, part int, docs binary, body binary, hashes binary"


def _homeward(buckets: int):
    """Spans packed by bucket, which a document's id and key decide; ``part`` is that of requests, -1 for others."""

    def given(own: np.ndarray, start: np.ndarray, end: np.ndarray, shard: np.ndarray, request: bool) -> Iterator[pa.RecordBatch]:
        if not len(own):
            return
        mark = tb.mixed(tb.mixed(own["id"].astype(np.uint64)) ^ own["key"].astype(np.uint64))
        order = np.argsort(mark)
        own, start, end, shard = own[order], start[order], end[order], shard[order]
        bucket = ((mark[order] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
        edges = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        part, hashes = int(shard[0] >> 32) if request else -1, shard.astype(np.uint32)
        rows = [(bucket[a], part, *_packed_spans(own[a:b], start[a:b], end[a:b]), hashes[a:b].tobytes() if request else b"") for a, b in zip(edges, np.append(edges[1:], len(own)))]
        kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["bucket", "part", "docs", "body", "hashes"])

    return given


def _home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """By document what all parts decided, as few spans, and all that they ask for."""

    def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
        bucket, part = table.column("bucket").to_numpy(), table.column("part").to_numpy()
        docs, body, hashes = (table.column(c).to_pylist() for c in ("docs", "body", "hashes"))
        for b in np.unique(bucket):
            for request in (False, True):
                at = np.flatnonzero((bucket == b) & ((part >= 0) == request))
                if not len(at):
                    continue
                own, start, end = (np.concatenate(x) for x in zip(*(_unpacked_spans(docs[i], body[i]) for i in at)))
                if request:
                    shard = np.concatenate([(np.int64(part[i]) << 32) | np.frombuffer(hashes[i], np.uint32).astype(np.int64) for i in at])
                else:
                    own, start, end = _union(own, start, end)
                    shard = np.zeros(len(own), np.int64)
                yield from _by_document(own, start, end, shard, request)

    return sorted_groups(batches, "bucket", work)


def _undecided(rows: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, last) of each row's strings that another text of the hash may hold, too, by the bytes
    that agree around the gram; -1 for last where there is none."""
    first, last = np.full(len(rows), length, np.int64), np.full(len(rows), -1, np.int64)
    around, count = rows["around"], rows["count"].astype(np.int64)
    gram_at = (around >> _GRAM_AT).astype(np.int64)
    for q, (low, high) in enumerate(_quarters(length - GRAM + 1)):
        side = (around >> np.uint64(_SIDE_BITS * q)) & _SIDE
        has = np.flatnonzero(side)
        if len(has) < 2:
            continue
        key = (rows["hash"][has].astype(np.uint64) << np.uint64(_SIDE_BITS)) | side[has]
        order = np.lexsort((rows["text"][has], key))
        ranked, text = key[order], rows["text"][has][order]
        edges = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
        group = np.repeat(np.arange(len(edges)), np.diff(np.append(edges, len(ranked))))
        several = np.zeros(len(edges), bool)
        differs = (ranked[1:] == ranked[:-1]) & (text[1:] != text[:-1])
        several[group[1:][differs]] = True
        hit = has[order[several[group]]]
        first[hit] = np.minimum(first[hit], np.maximum(gram_at[hit] - high, 0))
        last[hit] = np.maximum(last[hit], np.minimum(gram_at[hit] - low, count[hit] - 1))
    return first, last


def _by_document(own: np.ndarray, start: np.ndarray, end: np.ndarray, shard: np.ndarray, request: bool) -> Iterator[pa.RecordBatch]:
    """One row for each document, with its spans as lists."""
    if not len(own):
        return
    order = np.lexsort((own["key"], own["id"]))
    own, start, end, shard = own[order], start[order], end[order], shard[order]
    edges = np.flatnonzero(_new(own))
    at = pa.array(np.append(edges, len(own)).astype(np.int32))
    lists = [pa.ListArray.from_arrays(at, pa.array(x.astype(kind))) for x, kind in ((start, np.int32), (end, np.int32), (shard, np.int64))]
    yield pa.RecordBatch.from_arrays(
        [pa.array(own["id"][edges]), pa.array(own["key"][edges]), pa.array(np.full(len(edges), request)), *lists],
        names=["id", "key", "request", "starts", "ends", "shards"],
    )


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The requested texts: (shard, id, key, at, bytes)."""
    for batch in batches:
        data, offsets = tb.utf8(batch.column(2))
        row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(batch.column(3)).to_numpy(zero_copy_only=False))
        at, end, shard = (batch.column(c).flatten() for c in (3, 4, 5))
        low, high = offsets[row] + at.to_numpy(), offsets[row] + end.to_numpy()
        raw = data.tobytes()
        body = pa.array([raw[a:b] for a, b in zip(low.tolist(), high.tolist())], pa.binary())
        take = pa.array(row, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [shard, batch.column(0).take(take), batch.column(1).take(take), at, body],
            names=["shard", "id", "key", "at", "body"],
        )


def repeated_starts(texts: list[bytes], ids: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(text, place) of each string of ``length`` that a text with a smaller id holds, too.

    By the suffix array of all texts: induced sorting, then permuted common prefixes; neighbours
    that share ``length`` bytes form the groups of equal strings.
    """
    sizes = np.array([len(t) + 1 for t in texts])
    seq = np.frombuffer(b"".join(t + b"\0" for t in texts), np.uint8).astype(np.uint16) + np.uint16(1)
    ends = np.cumsum(sizes)
    seq[ends - 1] = 0  # separators
    if seq.max() < 256:  # no byte of UTF-8 is 255
        seq = seq.astype(np.uint8)
    array = induced(seq)
    common = permuted_lcp(seq, array, length)[array] >= length
    owner = np.repeat(np.arange(len(texts)), sizes)
    left = (ends[owner] - 1) - np.arange(len(seq))  # bytes from here to the text's end
    group = np.cumsum(~common) - 1
    edges = np.flatnonzero(~common)
    inside = left[array] >= length
    least = np.minimum.reduceat(np.where(inside, ids[owner[array]], NO_ID), edges) if len(edges) else ids[:0]
    hit = array[inside & (ids[owner[array]] > least[group])]
    hit = np.sort(hit)
    return owner[hit], hit - (ends - sizes)[owner[hit]]


def _compare(length: int):
    def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
        shard = table.column("shard").to_numpy()
        texts = table.column("body").to_pylist()
        own = np.zeros(len(shard), _DOC)
        own["id"], own["key"] = table.column("id").to_numpy(), table.column("key").to_numpy()
        at = table.column("at").to_numpy().astype(np.int64)
        edges = np.concatenate([[0], np.flatnonzero(np.diff(shard)) + 1, [len(shard)]])
        sizes = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        low = 0
        for edge in range(1, len(edges)):  # whole groups up to a shard's size
            if edge < len(edges) - 1 and sizes[edges[edge + 1]] - sizes[edges[low]] <= SHARD_BYTES:
                continue
            a, b = edges[low], edges[edge]
            low = edge
            text, place = repeated_starts(texts[a:b], own["id"][a:b], length)
            if len(text):
                jump = np.append(True, (text[1:] != text[:-1]) | (place[1:] != place[:-1] + 1))
                first = np.flatnonzero(jump)
                last = np.append(first[1:], len(text)) - 1
                row = a + text[first]
                start, end = at[row] + place[first], at[row] + place[last] + length
                yield from _by_document(own[row], start, end, np.zeros(len(row), np.int64), False)

    return lambda batches: sorted_groups(batches, "shard", work)


_SPANS_SCHEMA = "id long, key int, request boolean, starts array<int>, ends array<int>, shards array<long>"


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(id, key, starts, ends): spans to remove, several rows for a document; NO_ID for a null id."""
    spark = docs.sparkSession
    parts = max(8, docs.select("text").rdd.getNumPartitions())
    dealt = docs.select("id", "key", "text").mapInArrow(_map(parts, length, hot_anchors(docs, length)), "part int, decided boolean, docs binary, body binary")
    reduced = dealt.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(_reduce(length, _homeward(parts)), _HOME_SCHEMA)
    gathered = reduced.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(_home, _SPANS_SCHEMA)
    # what is written needs its shuffles no more
    with setting(spark, SHUFFLE_CLEANUP, "true"):
        found = stored(spark, gathered, "spans")
    wanted = found.where("request").select("id", "key", "starts", "ends", "shards")
    asked = docs.select(F.coalesce("id", F.lit(NO_ID)).alias("id"), "key", "text").join(wanted, ["id", "key"]).select("id", "key", "text", "starts", "ends", "shards")
    texts = asked.mapInArrow(_fetch, "shard long, id long, key int, at int, body binary")
    # rows of a shard meet once; equal ones, of repeated rows, go where they meet
    compared = texts.repartition(parts, "shard").distinct().sortWithinPartitions("shard", "id").mapInArrow(_compare(length), _SPANS_SCHEMA)
    with setting(spark, SHUFFLE_CLEANUP, "true"):
        decided = stored(spark, compared, "spans")
    return found.where("NOT request").union(decided).select("id", "key", "starts", "ends")


def deduplicate(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Each row of ``docs`` as struct ``row`` with n_bytes, n_removed, n_spans and the ``kept`` bytes."""
    keyed = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"),
        docs["doc_id"].cast("long").alias("id"),
        F.hash(docs["text"].cast("string")).alias("key"),
        docs["text"].cast("string").alias("text"),
    )
    spans = repeated_spans(keyed.select("id", "key", "text"), length).groupBy("id", "key").agg(
        F.flatten(F.collect_list("starts")).alias("starts"), F.flatten(F.collect_list("ends")).alias("ends")
    )
    # the text goes through the join once, within the row
    joined = keyed.select("row", F.coalesce("id", F.lit(NO_ID)).alias("id"), "key").join(spans, ["id", "key"], "left").select(
        "row", F.col("row").getField("text").cast("string").alias("text"), "starts", "ends"
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, count, kept = [], [], [], []
            data, offsets = tb.utf8(batch.column(1))
            for i in range(batch.num_rows):
                own = data[offsets[i] : offsets[i + 1]]
                starts = batch.column(2)[i].values
                if starts is None:
                    removed.append(0)
                    count.append(0)
                    kept.append(own.tobytes())
                else:
                    step = np.zeros(len(own) + 1, np.int64)
                    np.add.at(step, starts.to_numpy(), 1)
                    np.add.at(step, batch.column(3)[i].values.to_numpy(), -1)
                    gone = np.cumsum(step[:-1]) > 0
                    removed.append(int(gone.sum()))
                    count.append(int((gone & ~np.append(False, gone[:-1])).sum()))
                    kept.append(own[~gone].tobytes())
                sizes.append(len(own))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in (sizes, removed, count)), pa.array(kept, pa.binary())],
                names=["row", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    schema = T.StructType([joined.schema["row"], *(T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")), T.StructField("kept", T.BinaryType())])
    return joined.mapInArrow(task, schema)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return deduplicate(docs).select(
        F.col("row.doc_id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


ORACLES = {
    "op9_substring_dedup": f"""WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
b AS (SELECT doc_id, i, substr(h, CAST(2 * i + 1 AS BIGINT), 2) AS byte,
    CASE WHEN 2 * (i + {LENGTH}) <= len(h) THEN substr(h, CAST(2 * i + 1 AS BIGINT), {2 * LENGTH}) END AS win
  FROM (SELECT doc_id, h, unnest(range(len(h) // 2)) AS i FROM d)),
m AS (SELECT win, min(doc_id) AS least FROM b WHERE win IS NOT NULL GROUP BY win),
f AS (SELECT doc_id, i, byte, coalesce(least < doc_id, false) AS flag FROM b LEFT JOIN m USING (win)),
c AS (SELECT doc_id, i, byte,
    bool_or(flag) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN {LENGTH - 1} PRECEDING AND CURRENT ROW) AS gone FROM f),
g AS (SELECT *, gone AND NOT lag(gone, 1, false) OVER (PARTITION BY doc_id ORDER BY i) AS first FROM c),
r AS (SELECT doc_id, count(*) AS n_bytes, count(*) FILTER (gone) AS n_removed, count(*) FILTER (first) AS n_spans,
    string_agg(byte, '' ORDER BY i) FILTER (NOT gone) AS kept FROM g GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_bytes, 0) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, ''))) AS kept_sha256 FROM d LEFT JOIN r USING (doc_id)"""
}
