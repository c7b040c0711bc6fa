"""Repeated line runs against brute force."""

import numpy as np
import pyarrow as pa
import pytest
from curbflow.llm import line_dedup
from llm_brute import line_brute as brute


def rows(frame):
    return sorted((tuple(r) for r in frame.select("doc_id", "text", "lines_removed").collect()), key=repr)


def test_query_on_whole_tables(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    want = brute(docs, line_dedup.MIN_WORDS)
    assert rows(line_dedup.op4_line_dedup(spark, sf_dir)) == want
    assert any(r[2] for r in want)


@pytest.mark.parametrize("seed", range(3))
def test_random_runs(spark, seed):
    """Few distinct lines, so that runs of all lengths repeat within and across documents."""
    rng = np.random.default_rng(seed)
    docs = []
    for i in range(40):
        n = int(rng.integers(0, 30))
        docs.append((i, "\n".join(rng.choice(["a", "b c", "d e f", "", f"u{i} v"], n, p=[0.4, 0.25, 0.15, 0.1, 0.1]))))
    docs += [(100, docs[3][1] + "\nx y\n" + docs[4][1]), (101, "\n".join(["q"] * 50))]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert rows(line_dedup.deduplicate(frame, 4)) == brute(docs, 4)


def test_earlier_copy_ends_within_the_later_one(spark):
    """The next line of the later copy has its copy at the start of another stretch."""
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(12)) for x in "abcd")
    for docs in (
        [(1, f"{a}\n{b}\nonce\n{c}\n{d}"), (2, f"{a}\n{b}\n{c}\n{d}")],
        [(1, f"{a}\n{b}"), (2, f"{c}\n{d}"), (3, f"{a}\n{b}\n{c}\n{d}")],
    ):
        frame = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
        got = rows(line_dedup.deduplicate(frame))
        assert got == brute(docs, line_dedup.MIN_WORDS)
        assert got[-1][1:] == ("", 4)


@pytest.mark.parametrize("seed", range(4))
def test_ranges_of_the_suffix_array(seed):
    """Cut at any places, a group of one first line gives the runs of all its pairs of suffixes."""
    rng = np.random.default_rng(seed)
    seq = rng.choice(3, 400, p=[0.85, 0.1, 0.05]).tolist() if seed else [0] * 400
    order = sorted(range(len(seq)), key=lambda i: seq[i:])
    both = lambda a, b: next((n for n, (x, y) in enumerate(zip(seq[a:], seq[b:])) if x != y), len(seq) - max(a, b))
    lcp = [0, *map(both, order, order[1:])]
    want = {i: n for i in range(len(seq)) if (n := max((both(i, j) for j in range(i)), default=0))}
    cuts = np.sort(rng.choice(400, 30))
    number = np.searchsorted(cuts, np.arange(400), side="right")
    table = pa.RecordBatch.from_arrays([pa.array(number.astype(np.int64)), pa.array(order, pa.int64()), pa.array(lcp, pa.int64())], names=["range", "g", "lcp"])
    packed = pa.Table.from_batches(line_dedup.packed_ranges(iter([table.slice(0, 150), table.slice(150)]))).to_pylist()
    assert max(len(r["g"]) for r in packed) < 100  # no walk over the whole group
    ends = [{"range": r["range"], "head": r["lcp"][0], **r} for r in packed]
    rows = [
        {"g": r["g"], "lcp": r["lcp"], "before_g": b[0].tolist(), "before_lcp": b[1].tolist(), "after_g": a[0].tolist(), "after_lcp": a[1].tolist()}
        for r, b, a in zip(ends, *line_dedup.passed_on(ends))
    ]
    kinds = pa.schema([(c, pa.list_(pa.int64())) for c in ("g", "lcp", "before_g", "before_lcp", "after_g", "after_lcp")])
    got = pa.Table.from_batches(line_dedup.longest_earlier(iter([pa.RecordBatch.from_pylist(rows, kinds)])))
    assert dict(zip(got["g"].to_pylist(), got["lines"].to_pylist())) == want
    assert got.num_rows == len(want)


@pytest.mark.parametrize("seed", range(3))
def test_borders_pass_through_groups(spark, seed):
    """Passed on in groups of ranges, borders are those of one pass."""
    rng = np.random.default_rng(seed)
    rows, g = [], rng.permutation(600).tolist()
    for i in range(60):
        own, lcp = g[10 * i : 10 * i + 10], rng.integers(0, [3, 40, 2][seed], 10).tolist()
        batch = pa.RecordBatch.from_arrays([pa.array([i] * 10, pa.int64()), pa.array(own, pa.int64()), pa.array(lcp if i else [0, *lcp[1:]], pa.int64())], names=["range", "g", "lcp"])
        rows += pa.Table.from_batches(line_dedup.packed_ranges(iter([batch]))).to_pylist()
    ends = [{"head": r["lcp"][0], **r} for r in rows]
    want = line_dedup.passed_on(ends)
    cuts = [0, 1, 2, 17, 40, 60]
    groups = [ends[a:b] for a, b in zip(cuts, cuts[1:])]
    before, after = line_dedup.passed_on([line_dedup.as_one(x) for x in groups])
    got = [line_dedup.passed_on(x, b, a) for x, b, a in zip(groups, before, after)]
    same = lambda x, y: all((p == q).all() and len(p) == len(q) for p, q in zip(x, y))
    assert all(same(x, y) for k in (0, 1) for x, y in zip([b for part in got for b in part[k]], want[k]))
    frame = spark.createDataFrame(rows).repartition(7)
    table = {r["range"]: r for r in line_dedup.borders(frame).collect()}
    for i, (b, a) in enumerate(zip(*want)):
        assert (table[i]["before_g"], table[i]["before_lcp"], table[i]["after_g"], table[i]["after_lcp"]) == tuple(x.tolist() for x in (*b, *a))


def test_ranks_across_partitions(spark):
    """Names are r plus the rows of r with a smaller r2, also where a rank spans partitions."""
    rows = [(r, r2, 1 + (r * r2) % 3) for r, many in ((0, 500), (700, 1), (800, 3), (2000, 400)) for r2 in range(-1, many - 1)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        names, hot = line_dedup.ranked(spark, spark.createDataFrame(rows, "r long, r2 long, n long"))
        got = {(x["r"], x["r2"]): x["name"] for x in names.collect()}
        assert hot is None
        _, hot = line_dedup.ranked(spark, spark.createDataFrame([*rows, (5000, 7, 90)], "r long, r2 long, n long"))
        assert [tuple(x) for x in hot.collect()] == [(5000, 7)]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == {(r, r2): r + sum(n for a, b, n in rows if a == r and b < r2) for r, r2, _ in rows}


def test_scripts_without_spaces(spark):
    """A line of Chinese characters weighs by its letters, a short one stays."""
    docs = [(1, "这是一个没有空格的很长的句子它重复出现在文档里\nx"), (2, "这是一个没有空格的很长的句子它重复出现在文档里\ny"), (3, "短句子\nz"), (4, "短句子\nq")]
    got = rows(line_dedup.deduplicate(spark.createDataFrame(docs, "doc_id long, text string")))
    assert got == brute(docs, line_dedup.MIN_WORDS) and [r[2] for r in got] == [0, 1, 0, 0]


def test_edge_cases(spark):
    long = " ".join(f"w{i}" for i in range(60))
    docs = [
        (1, None), (2, ""), (3, long), (3, long), (4, long + "\nown words"), (None, long), (5, "\n\n\n"), (6, "\n\n\n"),
        (7, "é " * 30000), (8, "é " * 30000), (9, "short"), (10, "short"),
    ]
    frame = spark.createDataFrame([(d, t, i) for i, (d, t) in enumerate(docs)], "doc_id long, text string, key int")
    got = line_dedup.deduplicate(frame)
    assert rows(got) == brute(docs, line_dedup.MIN_WORDS)
    assert got.columns == ["doc_id", "text", "key", "lines_removed"]
    assert line_dedup.deduplicate(frame, drop_emptied=True).count() == len(docs) - 2
    assert line_dedup.deduplicate(frame.limit(0)).count() == 0
