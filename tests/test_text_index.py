"""Searches on the stored text index against a scan of the latest texts."""

import random
import re

import pytest
from pyspark.sql import functions as F

from curbflow.functions.predicates import bool_query, match_text, term
from curbflow.sinks import manifests, text_index, upserts

SCHEMA = "id long, at int, lang string, text string"
WORDS = "the Search and über straße 12 naïve x-ray 東京 don't".split()
CLAUSES = [["the"], ["search and"], ["ÜBER the", "12"], ["x ray", "don", "東京"], ["nothing here"], ["the", "--"], []]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def scan(spark, state, must, lang=None):
    filters = [term("lang", lang)] if lang else []
    docs = frame(spark, list(state.values()))
    return sorted(((r["id"], r["at"]) for r in docs.filter(bool_query([match_text("text", m) for m in must], filters)).collect()), key=repr)


def found(spark, path, must, lang=None):
    hits = text_index.search_texts(spark, path, must, F.col("lang") == lang if lang else None, ["id", "at"])
    return sorted(((r["id"], r["at"]) for r in hits.collect()), key=repr)


def test_searches_equal_a_scan_over_appends_updates_and_compaction(spark, tmp_path):
    path, draw, state = str(tmp_path / "ix"), random.Random(8), {}
    for batch in range(4):
        rows = []
        for i in range(40):
            text = draw.choice([None, "", " ".join(draw.choices(WORDS, k=draw.randrange(1, 12)))])
            rows.append((draw.choice([None, 1, *range(60)]), batch * 100 + i, draw.choice(["en", "de", None]), text))
        for r in rows:
            state[r[0]] = max(state.get(r[0], r), r, key=lambda r: r[1])
        assert text_index.index_texts(spark, path, frame(spark, rows), "id", ["at"], buckets=4, batch=("s", batch))
        assert not text_index.index_texts(spark, path, frame(spark, rows[:3]), "id", ["at"], buckets=4, batch=("s", batch))
        if batch == 2:
            assert text_index.compact(spark, path) > 0
    for must in CLAUSES:
        assert found(spark, path, must) == scan(spark, state, must)
        assert found(spark, path, must, "en") == scan(spark, state, must, "en")
    assert not text_index.index_texts(spark, path, frame(spark, []), "id", ["at"], buckets=4, batch=("s", 9))
    with pytest.raises(ValueError):
        text_index.index_texts(spark, path, frame(spark, rows), "id", ["at"], buckets=8)


def test_no_text_and_only_the_tokens_own_buckets_are_read(spark, tmp_path):
    path = str(tmp_path / "ix")
    rows = [(i, 1, "en", f"word{i} common") for i in range(300)]
    text_index.index_texts(spark, path, frame(spark, rows), "id", ["at"], buckets=32)
    hits = text_index.search_texts(spark, path, ["word7", "common"])
    assert [tuple(r) for r in hits.collect()] == [(7, 1, "en")]
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "text" not in " ".join(re.findall(r"ReadSchema: struct<([^>]*)>", plan))
    buckets = {re.search(r"/tokens/.*_bucket=(\d+)/", f).group(1) for f in hits.inputFiles() if "/tokens/" in f}
    assert 0 < len(buckets) <= 2


def test_tokens_without_their_fields_are_not_seen(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "ix")
    first, second = frame(spark, [(1, 1, "en", "old words")]), frame(spark, [(1, 2, "en", "new words"), (2, 1, "en", "new")])
    text_index.index_texts(spark, path, first, "id", ["at"], buckets=2, batch=("s", 0))

    def lost(*_, **__):
        raise OSError("the driver is gone")

    with monkeypatch.context() as broken:
        broken.setattr(upserts, "upsert", lost)
        with pytest.raises(OSError):
            text_index.index_texts(spark, path, second, "id", ["at"], buckets=2, batch=("s", 1))
    assert found(spark, path, ["new"]) == [] and found(spark, path, ["old"]) == [(1, 1)]
    assert text_index.index_texts(spark, path, second, "id", ["at"], buckets=2, batch=("s", 1))
    assert found(spark, path, ["new"]) == [(1, 2), (2, 1)] and found(spark, path, ["old"]) == []
    assert len(manifests.versions(spark, f"{path}/tokens")) == 2


def test_a_stream_is_indexed(spark, tmp_path):
    arrived, path, checkpoint = (str(tmp_path / n) for n in ("arrived", "ix", "checkpoint"))
    for b in range(3):
        frame(spark, [(1, b, "en", f"batch{b}"), (b + 10, 0, "en", "kept")]).coalesce(1).write.mode("append").parquet(arrived)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(arrived)
    text_index.stream_texts(stream, path, checkpoint, "id", ["at"], buckets=2, interval=None, above=1).awaitTermination()
    assert found(spark, path, ["kept"]) == [(b + 10, 0) for b in range(3)]
    assert found(spark, path, ["batch0 batch1"]) == [] and found(spark, path, ["batch2"]) == [(1, 2)]
