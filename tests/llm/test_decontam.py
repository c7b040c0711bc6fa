"""Decontamination against brute force over windows."""

import pytest
from curbflow.llm import decontam
from llm_brute import decontam_brute as brute


def result(frame):
    got = frame.selectExpr(
        "row.doc_id", "n_words", "n_hit", "size(found) n", "sha2(array_join(array_sort(found.item), ','), 256) h", "n_hit > 0 c"
    )
    return sorted((tuple(r) for r in got.collect()), key=repr)


def test_query_on_whole_tables(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    got = decontam.op6_decontaminate(spark, sf_dir)
    want = brute(docs, items)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want
    assert any(r[-1] for r in want)


LONG = " ".join(f"w{i % 7}x" for i in range(300))
DOCS = [
    (1, None, 1), (2, "", 2), (3, "one two THREE four", 3), (3, "one two THREE four", 3), (None, "two three", 4),
    (5, " ".join(f"k{i}" for i in range(40)), 5), (6, LONG, None), (7, "É-é über k1", 7), (8, "one two", 8),
]
ITEMS = [
    (10, " ".join(f"k{i}" for i in range(5, 25))), (9, "two, three"), (9, "über"), (None, "one two"), (11, ""), (12, None),
    (13, LONG), (14, "two three"),
]


@pytest.mark.parametrize("limit", [1 << 20, 60])
def test_edge_cases_and_slices(spark, monkeypatch, limit):
    monkeypatch.setattr(decontam.slices, "__defaults__", (decontam.WINDOW, limit))
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, n_hit long")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    frame = decontam.find_matches(docs, items)
    assert result(frame) == brute([d[:2] for d in DOCS], ITEMS)
    clean = decontam.decontaminate(docs, items)
    assert clean.columns == docs.columns
    assert {r["doc_id"] for r in clean.collect()} == {1, 2, 8}


def test_longest_match_and_place(spark):
    docs = spark.createDataFrame([(1, "a b " + " ".join(f"k{i}" for i in range(3, 20)) + " z")], "doc_id long, text string")
    items = spark.createDataFrame([(10, " ".join(f"k{i}" for i in range(30)))], "item_id long, text string")
    (row,) = decontam.find_matches(docs, items).collect()
    assert [tuple(f) for f in row["found"]] == [("10", 17, 3, 2)]
    assert [tuple(s) for s in row["spans"]] == [(2, 19)]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    assert [r["n_hit"] for r in decontam.find_matches(docs, items).collect()] == [0]
    assert decontam.find_matches(docs.limit(0), items).count() == 0
