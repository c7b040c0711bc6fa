"""Held-out accuracy, the counterfactual penalty, the field's marginals, and edge cases."""

import itertools
import zlib

import numpy as np
import pytest
from curbflow.llm import classify, quality, toxicity

LARGER = "/root/testdata/sf0.01"


def joined(spark, rows, label):
    labels = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{LARGER}/labels.parquet").collect()}
    return [(r["held_out"], r["score"], r["predicted"], labels[r["doc_id"]]) for r in rows if r["doc_id"] in labels]


def test_held_out_rule(spark):
    rows = spark.range(500).selectExpr("id AS doc_id").select("doc_id", classify.held_out().alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)


def test_training_rows_leave_out_held_out_null_and_contradicting_labels(spark):
    docs = spark.createDataFrame([(i, f"text {i}", "x") for i in range(200)] + [(None, "null", "x")], "doc_id long, text string, label string")
    labels = [(i, i % 2) for i in range(200)] + [(1, 0), (None, 1), (5, None), (7, 3)]
    frame = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r["text"]: r["label"] for r in classify.training_rows(docs, frame, "toxic").collect()}
    want = {f"text {i}": i % 2 for i in range(200) if i != 1 and zlib.crc32(str(i).encode()) % 4 != 2}
    assert got == want
    assert classify.training_rows(docs, frame, "toxic", 10).count() == 10


@pytest.mark.parametrize("module,query,label,low", [(quality, "op7_quality", "quality", 0.95), (toxicity, "op2_toxicity", "toxic", 0.9)])
def test_accuracy_on_held_out_documents(spark, module, query, label, low):
    rows = getattr(module, query)(spark, LARGER).collect()
    assert len(rows) == 1000 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= module.THRESHOLD) for r in rows)
    unseen = [(p, y) for held, _, p, y in joined(spark, rows, label) if held]
    assert np.mean([p == y for p, y in unseen]) >= low
    clean = [p for p, y in unseen if y == (1 if label == "quality" else 0)]
    assert np.mean([p == (label == "quality") for p in clean]) >= 0.95


def test_penalty_frees_neutral_mentions(spark):
    """In the labelled rows one group is mentioned in most attacks and in few other texts."""
    texts, k = [], 0
    for k in range(400):
        filler = f"today a{k % 23} b{k % 17} c{k % 13} walked home"
        if k % 2:
            texts.append((f"{filler} muslims are scum" if k % 10 else f"{filler} scum", 1))
        else:
            texts.append((f"{filler} christians sing" if k % 4 else f"{filler} sing", 0))
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(texts)], "doc_id long, toxic int")
    probe = ["today muslims walked home", "today christians walked home"]
    plain = toxicity.fit(docs, labels, penalty=0.0).score(probe)
    fair = toxicity.fit(docs, labels).score(probe)
    assert plain[0] - plain[1] > 0.2
    assert abs(fair[0] - fair[1]) < 0.05 and fair[0] < toxicity.THRESHOLD
    assert toxicity.fit(docs, labels).score(["today a1 b1 you scum"])[0] > 0.5


def test_forward_backward_against_all_labellings():
    rng = np.random.default_rng(0)
    rows = np.array([0, 4, 4 + 1, 5 + 6])
    scores, transitions = rng.normal(size=11), rng.normal(size=(2, 2))
    good, expected, _ = quality.forward_backward(scores, rows, transitions)
    want, pairs = np.zeros(11), np.zeros((2, 2))
    for a, b in zip(rows, rows[1:]):
        total, own, both = 0.0, np.zeros(b - a), np.zeros((2, 2))
        for labels in itertools.product([0, 1], repeat=b - a):
            weight = np.exp(sum(scores[a + i] * y for i, y in enumerate(labels)) + sum(transitions[p, q] for p, q in zip(labels, labels[1:])))
            total += weight
            own += weight * np.array(labels)
            for p, q in zip(labels, labels[1:]):
                both[p, q] += weight
        want[a:b] = own / total
        pairs += both / total
    assert np.allclose(good, want) and np.allclose(expected, pairs)


@pytest.mark.parametrize("module,label", [(quality, "quality"), (toxicity, "toxic")])
def test_edge_cases(spark, module, label):
    docs = [(1, None), (2, ""), (2, ""), (None, "x"), (3, "long " * 50000), (4, "\n" * 3000), (5, "a\r\n\r\nb|c ###"), (6, "日本 idiot")]
    frame = spark.createDataFrame([(d, t, 0.5) for d, t in docs], "doc_id long, text string, score double")
    none = spark.createDataFrame([], f"doc_id long, {label} int")
    scores = [r["score"] for r in module.score(frame, module.fit(frame, none)).collect()]
    assert len(scores) == len(docs) and len(set(scores)) == 1
    some = spark.createDataFrame([(i, i % 2) for i in range(1, 7)], f"doc_id long, {label} int")
    rows = module.score(frame, module.fit(frame, some)).collect()
    assert len(rows) == len(docs) and all(0 <= r["score"] <= 1 for r in rows)
    assert rows[0]["score"] == rows[1]["score"] == rows[2]["score"]
    assert module.score(frame.limit(0), module.fit(frame, some)).count() == 0
