"""Codes and codebooks against plain search over all entries."""

import hashlib

import numpy as np
import pytest
from curbflow.llm import vector_codes as vc


def brute(rows, rounds=vc.ROUNDS):
    """rows: (vec_id, integers, label)."""
    table = np.array([r[1] for r in rows], object)
    books = [table[: vc.ENTRIES, a:b].copy() for a, b in vc.bounds(table.shape[1])]

    def assigned():
        out = []
        for p, (a, b) in enumerate(vc.bounds(table.shape[1])):
            d = ((table[:, None, a:b] - books[p][None]) ** 2).sum(2)
            out.append([min((int(v), i) for i, v in enumerate(row)) for row in d])
        return out

    for _ in range(rounds):
        for p, (own, (a, b)) in enumerate(zip(assigned(), vc.bounds(table.shape[1]))):
            for c in range(len(books[p])):
                members = [k for k, (_, i) in enumerate(own) if i == c]
                if members:
                    books[p][c] = [sum(column) // len(members) for column in table[members, a:b].T]
    found = assigned()
    errors = [sum(found[p][k][0] for p in range(vc.PARTS)) for k in range(len(rows))]
    sha = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    return [
        (r[0], "".join(f"{found[p][k][1]:02x}" for p in range(vc.PARTS)), errors[k], sum(e for e, o in zip(errors, rows) if o[2] == r[2]), sha)
        for k, r in enumerate(rows)
    ]


@pytest.mark.parametrize("width,n", [(1, 5), (4, 256), (16, 200), (7, 70)])
def test_nearest(width, n):
    """Few values, so that distances tie; the masks leave out no entry within the radius."""
    rng = np.random.default_rng(width)
    book = vc.Codebook(rng.integers(-6, 6, (n, width)))
    parts = rng.integers(-9, 9, (1500, width))
    d = ((parts[:, None] - book.entries[None]) ** 2).sum(2)
    entry, error = book.nearest(parts)
    assert (entry == d.argmin(1)).all() and (error == d.min(1)).all()
    square = book.radius2(parts)
    assert (square >= d.min(1)).all()
    mask = book.candidates(parts, square)
    bits = (mask[:, np.arange(n) // 64] >> (np.arange(n) % 64).astype(np.uint64)) & np.uint64(1)
    assert bits[d <= square[:, None]].all()
    assert width > 7 or bits.mean() < 0.9  # and they do leave out others


def test_clustered_and_odd_vectors(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 10))
    rows = []
    for i in range(700):
        v = [float(x) for x in centres[i % 20] + 0.1 * rng.normal(size=10)]
        rows.append((1000 - i, v, [None, "a", "b"][min(i % 7, 2)]))
    rows += [(1, rows[5][1], "a"), (2, [1e30, -1e30] + [0.5] * 8, "c"), (2, [1e30, -1e30] + [0.5] * 8, "c")]
    odd = [(3, None, "a"), (4, [], "a"), (5, [0.1] * 9 + [float("nan")], "a"), (6, [0.1] * 9 + [float("inf")], "b"), (7, [0.1] * 9 + [None], "b"), (900001, [0.5] * 11, "a"), (None, [0.25] * 10, None)]
    frame = spark.createDataFrame([(*r, "x") for r in rows + odd], "vec_id long, embedding array<double>, label string, code string").repartition(5)
    codes, books = vc.compress(frame)
    got = sorted((tuple(r) for r in vc.with_label_error(codes).select("vec_id", "code", "error", "label_error").collect()), key=repr)
    ints = lambda v: [int(np.floor(1024 * max(-vc.MOST, min(vc.MOST, x)))) for x in v]
    clipped = lambda v: [max(-vc.MOST, min(vc.MOST, x)) for x in ints(v)]
    want = brute([(i, clipped(v), label) for i, v, label in sorted(rows, key=lambda r: (r[0], r[1]))] + [(None, [256] * 10, None)])
    assert got == sorted((w[:4] for w in want), key=repr)
    assert vc.digest(books) == want[0][4]
    assert codes.count() == len(rows) + 1


def test_empty_and_few(spark):
    frame = spark.createDataFrame([(1, [0.5, 0.25], 3)], "vec_id long, embedding array<float>, label int")
    codes, books = vc.compress(frame)
    assert [tuple(r) for r in vc.with_label_error(codes).collect()] == [(1, "3", "00000000", 0, 0)]
    codes, books = vc.compress(frame.limit(0))
    assert vc.with_label_error(codes).count() == 0 and books == []
