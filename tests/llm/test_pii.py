"""Base spans against Python's regular expressions, and the taught classifier on a small corpus."""

import hashlib
import re

import numpy as np
from curbflow.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def good(kind, text):
    d = [int(c) for c in text if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        return 16 <= len(d) <= 19 and sum(v if i % 2 == 0 else (2 * v - 9 if v > 4 else 2 * v) for i, v in enumerate(reversed(d))) % 10 == 0
    return kind == "email" or 8 <= len(d) <= 15


def brute(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PATTERNS.items() for m in re.finditer(p, text or "", re.ASCII) if good(k, m.group())]


def check(rows, texts):
    for row, text in zip(rows, texts):
        want = brute(text)
        assert [row[f"n_{k}"] for k in pii.KINDS] == [sum(w.startswith(k + ":") for w in want) for k in pii.KINDS], text
        assert row["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert set(want) <= set(row["spans"].split(",") if row["spans"] else [])


def test_query_on_whole_tables(spark, sf_dir):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = pii.op8_pii(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    check(rows, [docs[r["doc_id"]] for r in rows])
    assert sum(r["n_email"] for r in rows) and sum(r["n_phone"] for r in rows)


def query(frame):
    from pyspark.sql import functions as F

    found = pii.find_spans(frame)
    return found.select(
        "row", *[F.size(f"base_{k}").alias(f"n_{k}") for k in pii.KINDS], F.sha2(pii.listed("base"), 256).alias("base_sha256"), pii.listed("all").alias("spans")
    ).collect()


TEXTS = [
    None, "", "a@b", "x.y%+z@mail-1.example.com.", "a@b.c_d@e.f", "a@b.c@d.e", "é@x.y ÿa@b.de,c@d.fr;", "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.255 1.2.3",
    "4111 1111 1111 1111", "4111-1111-1111-1112", "5 5", "12345678901234567890123", "+1 (239) 555-1768 +1+2 +49(30)1234567. +1 23", "+12345678901234567",
    "日本 +44 20 7946 0958日", "4111111111111111 4111111111111111", "1" * 5000, "a" * 20000, "a@" * 3000, "a.b@" + "c." * 2000 + "d", " ".join("192.168.0.1" for _ in range(50)),
]


def test_edge_cases(spark):
    frame = spark.createDataFrame([(None if i == 3 else i, t, i) for i, t in enumerate(TEXTS)], "doc_id long, text string, all_email int")
    rows = sorted(query(frame), key=lambda r: r["row"]["all_email"])
    check(rows, TEXTS)
    assert rows[5]["row"].asDict() == {"doc_id": 5, "text": TEXTS[5], "all_email": 5}
    assert query(frame.limit(0)) == []


def test_added_spans(spark):
    texts = [f"write to me by mail at u{i}@mail{i}.example.com or call +1 (239) 555-17{i:02d}" for i in range(60)]
    texts += [f"contact mail: jane{i} (at) example (dot) com" for i in range(6)]
    texts += [f"phone 239-555-17{i:02d}" for i in range(6)] + [f"version 10.2{i}.3" for i in range(5)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sorted(query(frame), key=lambda r: r["row"]["doc_id"])
    check(rows, texts)
    assert all(r["spans"].startswith("email:14:") or r["spans"] for r in rows[60:66])
    assert all(r["spans"].startswith("phone:6:18") for r in rows[66:72])
    assert all(r["spans"] == "" for r in rows[72:])


def test_reliabilities_recover_good_and_bad_labelers():
    rng = np.random.default_rng(1)
    truth = rng.random(4000) < 0.4
    right = [0.95, 0.8, 0.9, 0.5]
    votes = np.stack([np.where(rng.random(4000) < p, truth, ~truth).astype(int) for p in right], axis=1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    posterior, table = pii.reliabilities(patterns, counts.astype(float))
    yes = dict(zip(map(tuple, patterns), posterior > 0.5))
    assert np.mean([yes[tuple(v)] == t for v, t in zip(votes, truth)]) > 0.94
    assert np.allclose(table[:, 1, 1], right, atol=0.06)


def test_running_sums(spark):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(2)
    rows = [rng.integers(0, 1 << 40, n).tolist() for n in (0, 1, 2, 255, 256, 257, 512, 1000)]
    frame = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, v array<bigint>")
    got = {r["i"]: r["s"] for r in frame.select("i", pii.running(F.col("v")).alias("s")).collect()}
    assert all(got[i] == np.cumsum(r).tolist() for i, r in enumerate(rows))


def test_free_spans_and_context_equal_the_plain_way(spark):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(3)
    rows = []
    for i in range(60):
        cuts = sorted(set(rng.integers(0, 80, rng.integers(0, 20)).tolist()))
        own = [(a, b, "x") for a, b in zip(cuts, cuts[1:]) if rng.random() < 0.6]
        taken = [(a, a + int(rng.integers(1, 6)), "y") for a in rng.integers(0, 80, rng.integers(0, 8)).tolist()]
        rows.append((i, own, taken))
    frame = spark.createDataFrame(rows, f"i int, own array<{pii._SPAN}>, taken array<{pii._SPAN}>")
    for r in frame.select("*", pii.free(F.col("own"), F.col("taken")).alias("free")).collect():
        assert r["free"] == [s for s in r["own"] if not any(t["start"] < s["end"] and s["start"] < t["end"] for t in r["taken"])]
    text = "".join(rng.choice(list("ab\n é日😀"), 1500))
    blocks = F.regexp_extract_all(F.lit(text), F.lit(f"((?s).{{1,{pii.BLOCK}}})"), F.lit(0))
    places = spark.range(len(text)).select(F.col("id").cast("int").alias("at"))
    for r in places.select("at", pii._before(blocks, F.col("at")).alias("b")).collect():
        assert r["b"] == text[max(0, r["at"] - 30) : r["at"]]


def test_a_megabyte_of_numbers_and_of_spans(spark):
    import time

    texts = ["1, " * 350_000, "call +1 (239) 555-1768 or a@b.de, 192.168.0.1 or 239-555-1768; " * 16_000]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    begun = time.monotonic()
    check(sorted(query(frame), key=lambda r: r["row"]["doc_id"]), texts)
    assert time.monotonic() - begun < 90
