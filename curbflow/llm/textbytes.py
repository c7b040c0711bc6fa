"""Vectorised work on the UTF-8 bytes of whole text columns, inside Arrow tasks.

A batch is cut into blocks of a quarter MB of text, which hold whole documents. Within a block words
are found in steps, which end between words and may end inside a document, so that temporary
arrays stay small however long a document is. A null text counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 18
STEP_BYTES = 1 << 18

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows in one array, and the n + 1 offsets into it."""
    if pa.types.is_large_string(column.type) or not pa.types.is_string(column.type):
        column = column.cast(pa.string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes; a longer document has a block of its own."""
    start, n = 0, len(offsets) - 1
    while start < n:
        end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        end = min(max(end, start + 1), n)
        yield start, end
        start = end


def byte_table(keep) -> np.ndarray:
    """A table over the 256 byte values, true where ``keep(byte)``."""
    return np.array([bool(keep(b)) for b in range(256)])


LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def runs(inside: np.ndarray, offsets: np.ndarray, cuts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal true runs; a run never crosses a document's border.

    ``cuts`` marks further positions (true at the first byte after a cut) where runs end.
    """
    n = len(inside)
    edge = np.zeros(n + 1, bool)
    if cuts is not None:
        edge[:n] = cuts
    edge[offsets] = True
    here, before = np.append(inside, False), np.append(False, inside)
    return np.flatnonzero(here & (edge | ~before)), np.flatnonzero(before & (edge | ~here))


def steps(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, limit: int | None = None) -> Iterator[tuple[int, int]]:
    """Byte ranges of about ``limit`` bytes that cut no run of bytes in the table ``inside``."""
    limit = limit or STEP_BYTES
    a, n = 0, len(data)
    while a < n:
        b = min(a + limit, n)
        if b < n and inside[LOWER[data[b - 1]]] and inside[LOWER[data[b]]]:
            border = offsets[np.searchsorted(offsets, b, side="right") - 1]
            outside = np.flatnonzero(~inside[LOWER[data[a:b]]])
            b = max(int(border), a + int(outside[-1]) + 1 if len(outside) else a)
            if b <= a:  # one run all the way: on to its end
                end = int(offsets[np.searchsorted(offsets, a + limit, side="left")])
                b = a + limit
                while b < end:
                    outside = np.flatnonzero(~inside[LOWER[data[b : min(b + limit, end)]]])
                    if len(outside):
                        b += int(outside[0])
                        break
                    b = min(b + limit, end)
        yield a, b
        a = b


def within(offsets: np.ndarray, a: int, b: int) -> np.ndarray:
    """The document borders in [a, b], counted from a."""
    return offsets[np.searchsorted(offsets, a, side="left") : np.searchsorted(offsets, b, side="right")] - a


def hashed_words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words (runs of bytes in ``inside`` after lower-casing A-Z), their starts and ends."""
    parts = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for a, b in steps(data, offsets, inside):
        low = LOWER[data[a:b]]
        starts, ends = runs(inside[low], within(offsets, a, b))
        parts.append((span_hash(prefix_sums(low), starts, ends), starts + a, ends + a))
    hashes, starts, ends = (np.concatenate(p) for p in zip(*parts))
    return hashes, starts, ends


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums of byte times power, from which ``span_hash`` takes any span's hash."""
    global _powers, _inverses
    while len(_powers) < len(data):
        k = len(_powers)
        top, low = _powers[-1:] * _BASE, _inverses[-1:] * _BASE_INVERSE
        _powers = np.concatenate([_powers, _powers * top])
        _inverses = np.concatenate([_inverses, _inverses * low])
        assert len(_powers) == 2 * k
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers[: len(data)], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, the same wherever the span lies."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    base = np.minimum(starts, len(_inverses) - 1)  # an empty span at the end has sum 0
    return mixed((sums[ends] - sums[starts]) * _inverses[base] + (ends - starts).astype(np.uint64))


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _MIX
    return h ^ (h >> np.uint64(29))


def word_rows(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """n + 1 offsets of each document's words in the list of all words."""
    return np.searchsorted(starts, offsets, side="left")
