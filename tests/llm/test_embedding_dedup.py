"""Embedding near-duplicates against all cosines."""

import math

import numpy as np
import pytest
from curbflow.llm import embedding_dedup


def brute(rows, cosine=0.95):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    ids = sorted({i for i, _ in good})
    vector = dict(good)
    parent = {i: i for i in ids}
    links = dict.fromkeys(ids, 0)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for p, a in enumerate(ids):
        for b in ids[p + 1 :]:
            u, v = vector[a], vector[b]
            if len(u) == len(v) and u @ v / np.sqrt(u @ u) / np.sqrt(v @ v) >= cosine:
                links[a] += 1
                links[b] += 1
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    named = {i for i, _ in good}
    out = []
    for i, v in rows:
        component = root(i) if i in named else i
        out.append((i, links.get(i, 0), component, i is None or component == i))
    return sorted(out, key=repr)


def got(frame):
    return sorted((tuple(r) for r in frame.select("vec_id", "n_links", "component_id", "kept").collect()), key=repr)


def test_query_on_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    want = brute(rows)
    assert got(embedding_dedup.op3_embedding_dedup(spark, sf_dir)) == want


def test_recall_at_the_threshold(spark):
    """Pairs just above the threshold, the hardest ones to find."""
    rng = np.random.default_rng(3)
    rows = []
    for k in range(150):
        u = rng.normal(size=64)
        w = rng.normal(size=64)
        u /= np.linalg.norm(u)
        w -= (w @ u) * u
        w /= np.linalg.norm(w)
        c = rng.uniform(0.951, 0.97)
        rows += [(2 * k, u.tolist()), (2 * k + 1, (c * u + math.sqrt(1 - c * c) * w).tolist())]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = sum(r[1] for r in got(embedding_dedup.near_duplicates(frame)))
    assert found / sum(r[1] for r in brute(rows)) >= 0.9


@pytest.mark.parametrize("shared", [0.5, 0.81, 0.9])
def test_recall_with_a_common_direction(spark, shared):
    """Centring widens the angle between vectors that share a direction; shared is their squared mean."""
    rng = np.random.default_rng(5)
    mean = rng.normal(size=64)
    mean *= math.sqrt(shared) / np.linalg.norm(mean)
    rows = []
    for k in range(150):
        u = rng.normal(size=64)
        u = mean + math.sqrt(1 - shared) * u / np.linalg.norm(u)
        u /= np.linalg.norm(u)
        w = rng.normal(size=64)
        w -= (w @ u) * u
        w /= np.linalg.norm(w)
        rows += [(2 * k, u.tolist()), (2 * k + 1, (0.952 * u + math.sqrt(1 - 0.952**2) * w).tolist())]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = sum(r[1] for r in got(embedding_dedup.near_duplicates(frame)))
    assert found / sum(r[1] for r in brute(rows)) >= 0.95


def test_large_group_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    rng = np.random.default_rng(4)
    base = rng.normal(size=32)
    rows = [(i, (base + 0.05 * rng.normal(size=32)).tolist()) for i in range(100)] + [(100 + i, rng.normal(size=32).tolist()) for i in range(60)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert got(embedding_dedup.near_duplicates(frame)) == brute(rows)


def test_edge_cases(spark):
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, [1.0, 1.0]),
        (7, [1.0, 1.0]), (8, [1.0, 1.0]), (9, [2.0, 2.0]), (10, [1.0, -1.0]), (None, [1.0, 1.0]), (11, [1.0, 1.0, 0.0]), (12, [1e-300, 1e-300]),
        (13, [-0.0, 3.0]), (14, [0.0, 3.0]),
    ]
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, id string")
    want = brute([r for r in rows if r[0] != 12])
    result = got(embedding_dedup.near_duplicates(frame))
    assert [r[0] for r in result if r[0] == 12] == [12]
    nine = {r[0]: r for r in result}
    assert nine[7][1:] == (3, 7, True) and nine[12][2] == 7  # 7, 8, 9 and 12 point the same way
    assert [r for r in result if r[0] not in (7, 8, 9, 12)] == [r for r in want if r[0] not in (7, 8, 9)]
    assert embedding_dedup.near_duplicates(frame.limit(0)).count() == 0
