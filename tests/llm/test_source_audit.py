"""The audit against counts over all words, with digests that are wide, narrow and colliding."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from curbflow.llm import source_audit as sa

_WORD = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, least=sa.LEAST_DOCS, top=sa.TOP):
    """rows: (text, lang, source)."""
    docs = [(g or "", s or "", _WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))) for t, g, s in rows]
    out = []
    for lang in {d[0] for d in docs}:
        df, counts = Counter(), defaultdict(Counter)
        for _, source, words in (d for d in docs if d[0] == lang):
            df.update(set(words))
            counts[source].update(words)
        kept = [w for w, n in df.items() if n >= least]
        v = len(kept)

        def shares(count):
            total = sum(count[w] for w in kept)
            return {w: 1 + 1_000_000_000 * (count[w] + 2) // (total + 2 * v) for w in kept}

        p = {s: shares(c) for s, c in counts.items()}
        q = shares(sum(counts.values(), Counter()))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in counts:
            pairs = sorted((-sum(f(p[s][w], p[o][w]) for w in kept), o.encode()) for o in counts if o != s)
            terms = sorted((-f(p[s][w], q[w]), w.encode()) for w in kept if counts[s][w] and p[s][w] > q[w])[:top]
            for part, found in (("pair", pairs), ("term", terms)):
                out += [(lang, s, part, item.decode(), -value, i + 1) for i, (value, item) in enumerate(found)]
    return sorted(out)


def made(seed, n=300):
    rng = np.random.default_rng(seed)
    vocabulary = [f"{a}{b}" for a in "abcdeÄé漢" for b in "xyzXYü"] + ["A", "É", "zz"]
    rows = []
    for _ in range(n):
        words = rng.choice(vocabulary, int(rng.integers(0, 12)), p=(w := 1 / np.arange(1, len(vocabulary) + 1)) / w.sum())
        rows.append((rng.choice([" ", ", ", "1", "\n"]).join(words), ["de", "en", None, "x"][min(int(rng.integers(0, 9)), 3) % 4], ["s", "t", "ü", None][int(rng.integers(0, 4))]))
    rows += [("", "solo", "s"), (None, "quiet", "a"), ("only few words", "quiet", "b"), (None, None, None)]
    return rows


@pytest.mark.parametrize("bits", [64, 5, 1])
def test_against_brute_force(spark, bits):
    rows = made(bits)
    frame = spark.createDataFrame([(t, g, s, i, "w") for i, (t, g, s) in enumerate(rows)], "text string, lang string, source string, digest long, word string").repartition(6)
    want = brute(rows)
    assert sorted(map(tuple, sa.audit(frame, bits).collect())) == want
    assert {r[2] for r in want} == {"pair", "term"}


def test_windows_and_steps(spark, monkeypatch):
    """Small windows and pair steps change nothing; a long text and repeated rows count whole."""
    rows = made(9) + [("ax by " * 30000, "de", "s")] * 2
    counted = sa.word_counts(sa._numbered(spark.createDataFrame(rows, "text string, lang string, source string"))[0])
    assert counted.agg({"n": "sum"}).first()[0] == sum(len(_WORD.findall(r[0] or "")) for r in rows)
    table = [(1, 5, 0, s, 10 * s + 1, 1) for s in range(40)]
    import pyarrow as pa

    columns = ["lang_id", "digest", "sub", "source_id", "p", "absent"]
    whole = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*table)], names=columns)

    def total(batches):
        sums = Counter()
        for b in sa._both(iter(batches)):
            for r in b.to_pylist():
                sums[r["a"], r["b"]] += r["part"]
        return sums

    want = total([whole])
    monkeypatch.setattr(sa, "PAIR_ROWS", 7)
    assert total([whole.slice(0, 11), whole.slice(11, 0), whole.slice(11)]) == want and len(want) == 40 * 39


def test_bit_field(spark):
    """Every wanted digest is in the field, at any size of it."""
    wanted = spark.range(-500, 500, 7).toDF("digest")
    digests = np.arange(-500, 500, 7)
    for field_bits in (25, 12, 3):
        field = sa.bit_field(wanted, field_bits)
        place = sa._place(digests, field_bits)
        assert ((field[place >> 3] >> (place & 7).astype(np.uint8)) & 1).all() and len(field) == max(1, 2**field_bits // 8)
        assert np.unpackbits(field).sum() <= len(digests)


def test_empty_table(spark):
    frame = spark.createDataFrame([], "text string, lang string, source string")
    assert sa.audit(frame).count() == 0
