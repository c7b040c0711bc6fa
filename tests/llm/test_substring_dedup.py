"""Repeated 50-byte strings against brute force."""

import hashlib

import numpy as np
import pytest
from curbflow.llm import substring_dedup, suffixes


def brute(docs, length=50):
    big = 1 << 63
    least = {}
    raw = [(big if d is None else d, (t or "").encode()) for d, t in docs]
    for d, t in raw:
        for i in range(len(t) - length + 1):
            s = t[i : i + length]
            least[s] = min(least.get(s, big), d)
    out = []
    for (d, t), (name, _) in zip(raw, docs):
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if least[t[i : i + length]] < d:
                gone[i : i + length] = True
        spans = int((gone & ~np.append(False, gone[:-1])).sum())
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((name, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def rows(frame):
    got = frame.selectExpr("row.doc_id", "n_bytes", "n_removed", "n_spans", "sha2(kept, 256)")
    return sorted((tuple(r) for r in got.collect()), key=repr)


def test_query_on_whole_tables(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in substring_dedup.op9_substring_dedup(spark, sf_dir).collect()), key=repr)
    want = brute(docs)
    assert got == want
    assert sum(r[2] for r in want) > 0


@pytest.mark.parametrize("seed, hot_rows", [(0, 8), (1, 8), (2, 1), (3, 4)])
def test_overlapping_pieces(spark, monkeypatch, seed, hot_rows):
    """Texts cut from a small pool of pieces at any byte, so that runs end everywhere."""
    monkeypatch.setattr(substring_dedup, "HOT_ROWS", hot_rows)
    rng = np.random.default_rng(seed)
    pool = "".join(rng.choice(list("ab é日"), 700))
    docs = []
    for i in range(60):
        cuts = [(int(a), int(a) + int(n)) for a, n in zip(rng.integers(0, 600, 4), rng.integers(5, 160, 4))]
        docs.append((i // 2 if i % 7 == 0 else i, "".join(pool[a:b] for a, b in cuts)))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert rows(substring_dedup.deduplicate(frame)) == brute(docs)


def test_a_hot_passage_is_dealt_string_by_string(spark):
    """A passage in a third of all documents, each time between other words."""
    rng = np.random.default_rng(9)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz "))
    passage = "".join(rng.choice(letters, 200))
    docs = []
    for i in range(900):
        left, right = ("".join(rng.choice(letters, 60)) for _ in range(2))
        docs.append((i, left + passage + right if i % 3 == 0 else left + right))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    assert rows(substring_dedup.deduplicate(frame)) == brute(docs)
    keyed = frame.selectExpr("doc_id AS id", "hash(text) AS key", "text")
    hot = substring_dedup.hot_anchors(keyed)
    assert 5 < len(hot) < 40
    largest = []
    for given in (np.zeros(0, np.uint64), hot):
        dealt = keyed.mapInArrow(substring_dedup._map(16, 50, given), "part int, decided boolean, docs binary, body binary")
        of_part = dealt.where("NOT decided").groupBy("part").agg({"body": "count"}).count()
        assert of_part == 16
        groups = {}
        for r in dealt.where("NOT decided").select("part", "body").collect():
            for h in np.frombuffer(r["body"], substring_dedup._ANCHOR)["hash"]:
                groups[r["part"], h] = groups.get((r["part"], h), 0) + 1
        largest.append(max(groups.values()))
    assert largest[0] > 250 and largest[1] <= 120, largest


@pytest.mark.parametrize("shared", [36, 70])
def test_only_text_around_agreeing_bytes_is_compared(spark, shared):
    """Shared passages shorter than a string ask for no text; longer ones for little beside themselves."""
    rng = np.random.default_rng(4)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz "))
    passage = "".join(rng.choice(letters, shared))
    docs = [(i, "".join(rng.choice(letters, 100)) + passage + "".join(rng.choice(letters, 100))) for i in range(60)]
    keyed = spark.createDataFrame(docs, "id long, text string").selectExpr("id", "hash(text) AS key", "text")
    dealt = keyed.mapInArrow(substring_dedup._map(4, 50, np.zeros(0, np.uint64)), "part int, decided boolean, docs binary, body binary")
    asked = dealt.repartition(4, "part").sortWithinPartitions("part").mapInArrow(substring_dedup._reduce(50), substring_dedup._SPANS_SCHEMA)
    spans = [s for r in asked.where("request").collect() for s in zip(r["starts"], r["ends"])]
    # fingerprints of ten bits agree by chance now and then
    assert len(spans) < 20 if shared < 50 else len(spans) >= 60
    assert sum(a < 91 or b > 109 + shared for a, b in spans) < 20


def test_copies_are_decided_in_few_spans(spark):
    """Whole copies far apart: what parts decide is one span for a document, not one for each of its anchors."""
    rng = np.random.default_rng(12)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz "))
    texts = ["".join(rng.choice(letters, 2000)) for _ in range(40)]
    docs = [(40 * copy + i, t) for copy in range(6) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartitionByRange(12, "doc_id")
    keyed = frame.selectExpr("doc_id AS id", "hash(text) AS key", "text")
    found = substring_dedup.repeated_spans(keyed).where("id >= 40").collect()
    assert len(found) <= 250 and sum(len(r["starts"]) for r in found) <= 250
    assert {(r["id"], tuple(r["starts"]), tuple(r["ends"])) for r in found} >= {(i, (0,), (2000,)) for i in range(40, 240)}
    assert rows(substring_dedup.deduplicate(frame)) == brute(docs)


@pytest.mark.parametrize("length", [50, 120])
def test_packed_anchors_come_back(length):
    """Also of a long document's later part and of strings of hot anchors; 25 bytes each and 12 for a document before."""
    rng = np.random.default_rng(5)
    sizes = rng.integers(0, 4000, 60)
    data = rng.choice(np.frombuffer(b"abcdefg ", np.uint8), sizes.sum())
    offsets = np.append(0, np.cumsum(sizes))
    found, upper = substring_dedup.anchors(data, offsets, length)
    start = offsets[found["doc"]] + found["at"]
    strings, high = substring_dedup._cut(found[:50], start[:50], substring_dedup.tb.prefix_sums(data), length)
    found, upper = np.concatenate([strings, found[50:]]), np.concatenate([high, upper[50:]])
    found["at"][-100:] += np.uint32(70_000_000)
    docs = np.zeros(60, substring_dedup._DOC)
    docs["id"], docs["key"] = rng.permutation(60) - 30, rng.integers(-(1 << 31), 1 << 31, 60)
    docs["id"][7] = substring_dedup.NO_ID
    part = (upper % np.uint64(16)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    size = 0
    for p, places, body in substring_dedup._packed(docs, found[order], part[order], length):
        got, own = substring_dedup._unpacked(places, body, length)
        want = found[part == p]
        for name in ("hash", "text", "at", "count", "around"):
            assert (got[name] == want[name]).all(), name
        assert (own == docs[want["doc"]]).all()
        size += len(places) + len(body)
    assert length > 50 or size < 27 * len(found)


def test_edge_cases(spark):
    line = "".join(f"{i:03d}é" for i in range(40))
    docs = [
        (1, None, 0), (2, "", 0), (3, line, 0), (3, line, 0), (4, line, 0), (None, line, 0), (None, "x" + line + "y", 0),
        (5, "a" * 500, 0), (6, "a" * 49, 0), (7, "a" * 50, None), (8, "z" * 20 + line[3:60] + "q", 0), (9, line + line, 0),
    ]
    frame = spark.createDataFrame(docs, "doc_id long, text string, key long")
    want = brute([d[:2] for d in docs])
    assert rows(substring_dedup.deduplicate(frame)) == want
    assert substring_dedup.deduplicate(frame.limit(0)).count() == 0


@pytest.mark.parametrize("wide", [2, 24])
def test_suffix_arrays(monkeypatch, wide):
    monkeypatch.setattr(suffixes, "WIDE", wide)
    rng = np.random.default_rng(0)
    for t in range(120):
        s = np.tile(rng.integers(0, 4, 7), 40) if t % 5 == 0 else rng.integers(0, int(rng.integers(1, 7)), int(rng.integers(1, 300)))
        want = sorted(range(len(s)), key=lambda i: list(s[i:]))
        array = suffixes.induced(s)
        assert list(array) == want == list(suffixes.doubled(s))
        common = suffixes.permuted_lcp(s, array, 20)
        for a, b in zip(array, array[1:]):
            k = 0
            while k < 20 and max(a, b) + k < len(s) and s[a + k] == s[b + k]:
                k += 1
            assert common[b] == k
