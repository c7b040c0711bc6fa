"""b-bit MinHash near-duplicates against all pairs on whole sets."""

import numpy as np
import pytest
from curbflow.llm import minhash
from llm_brute import minhash_brute as brute

def rows(frame):
    return sorted((tuple(r) for r in frame.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)


def test_query_on_whole_tables(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    want = brute(docs, 85)
    assert rows(minhash.op10_minhash(spark, sf_dir)) == want
    assert any(not r[3] for r in want)


def variants(n, changed, seed):
    """Copies of one text, each with some words changed."""
    rng = np.random.default_rng(seed)
    base = [f"w{i}" for i in range(200)]
    out = []
    for k in range(n):
        text = list(base)
        for i in rng.choice(200, changed, replace=False):
            text[i] = f"x{k}y{i}"
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize("changed", [1, 2, 3])
def test_groups_near_the_threshold(spark, changed):
    docs = [(i, t) for i, t in enumerate(variants(40, changed, changed))]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(minhash.near_duplicates(frame, 85)) == brute(docs, 85)


def test_edge_cases(spark):
    docs = [
        (1, None, "a"), (2, "", "b"), (3, "one two", "c"), (4, "ONE  two", None), (5, "one two", "c"), (5, "one two", "c"),
        (None, "one two", "d"), (6, "long " * 5000, "e"), (7, "long " * 5000, "e"), (8, " \t\n", "f"), (9, "a b c d e f", "g"),
    ]
    frame = spark.createDataFrame(docs, "doc_id long, text string, signature string")
    assert rows(minhash.near_duplicates(frame)) == brute([d[:2] for d in docs], 80)
    assert minhash.near_duplicates(frame.limit(0)).count() == 0


def test_hot_group_in_blocks(spark, monkeypatch):
    """A group whose smallest id is far from the others, compared in several blocks."""
    monkeypatch.setattr(minhash, "BLOCK", 8)
    texts = variants(60, 3, 5)
    texts[0] = " ".join(texts[0].split()[:-14] + ["z"] * 14)
    docs = list(enumerate(texts))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(minhash.near_duplicates(frame, 85)) == brute(docs, 85)
    assert rows(minhash.near_duplicates(frame, 70)) == brute(docs, 70)
