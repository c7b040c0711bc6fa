"""Packing: exact round trip of ids, gapless windows, little padding, and the placing rule."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from curbflow.llm import packing
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(pieces, docs, capacity):
    """``pieces`` with ids; ``docs`` rows of (doc_id, text), each packed for itself."""
    bpe = Tokenizer.from_file(PATH)
    want = defaultdict(list)
    for d, text in docs:
        want[d].append(tuple([*bpe.encode(text or "", add_special_tokens=False).ids, 1]))
    windows = defaultdict(list)
    got = defaultdict(list)
    for p in pieces:
        windows[p["sequence_id"]].append((p["offset"], p["length"]))
        got[p["doc_id"]].append(p)
    for d, texts in want.items():
        own = sorted(got.pop(d), key=lambda p: p["start"])
        flat = {}
        if len(texts) == 1:
            assert [p["start"] for p in own] == np.cumsum([0, *(p["length"] for p in own)])[:-1].tolist()
            flat = tuple(np.concatenate([np.frombuffer(bytes(p["ids"]), "<u4") for p in own]).tolist())
            assert flat == texts[0] and all(p["doc_tokens"] == len(flat) for p in own)
        else:
            assert sum(p["length"] for p in own) == sum(map(len, texts))
    assert not got
    for parts in windows.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0, *(n for _, n in parts)])[:-1].tolist()
        assert sum(n for _, n in parts) <= capacity
    return windows


def test_query_on_whole_tables(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    pieces = packing.pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), PATH).collect()
    windows = check(pieces, docs, packing.CAPACITY)
    total = sum(p["length"] for p in pieces)
    assert len(windows) <= total / packing.CAPACITY + 8
    crc = {(p["doc_id"], p["start"]): zlib.crc32(bytes(p["ids"])) for p in pieces}
    query = packing.op5_pack_documents(spark, sf_dir).collect()
    assert {(r["doc_id"], r["start"]): r["ids_crc32"] for r in query} == crc


@pytest.mark.parametrize("capacity", [8, 64])
def test_edge_cases(spark, capacity):
    docs = [(1, None), (2, ""), (3, "a b c d e f g"), (None, "x"), (4, "word " * 500), (5, "same text"), (5, "same text"), (6, "don't <|endoftext|>")]
    frame = spark.createDataFrame([(d, t, "k") for d, t in docs], "doc_id long, text string, start string").repartition(3)
    check(packing.pack(frame, PATH, capacity).collect(), docs, capacity)
    assert packing.pack(frame.limit(0), PATH).count() == 0


def test_place_minimises_squared_counts():
    rng = np.random.default_rng(0)
    packer = packing.LevelPacker(16)
    for _ in range(400):
        size = int(rng.integers(1, 16))
        counts = packer.counts.copy()

        def cost(level):
            after = counts.copy()
            if level:
                after[level] -= 1
            if level + size < 16:
                after[level + size] += 1
            return int((after[:16] ** 2).sum())

        levels = [0, *(h for h in range(1, 17 - size) if counts[h])]
        level = packer.place(size)
        assert level in levels and cost(level) == min(map(cost, levels))
        packer.add("x", size)
        assert [len(o) for o in packer.open] == packer.counts.tolist()
