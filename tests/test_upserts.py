"""The upsert index against a dictionary, with replays, races, failures and compaction."""

import random
import re

import pytest
from curbflow.sinks import manifests, upserts

SCHEMA = "id long, at int, text string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def held(spark, path, **options):
    rows = [tuple(r) for r in upserts.read_upserts(spark, path, **options).collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r for r in rows}


def put(state, rows):
    for r in rows:
        state[r[0]] = max(state.get(r[0], r), r, key=lambda r: r[1:])


def test_commits_replays_and_compaction_equal_a_dictionary(spark, tmp_path):
    path, draw, want, past = str(tmp_path / "ix"), random.Random(5), {}, []
    for batch in range(6):
        # a third of the updates hit one id, some have none
        rows = [(draw.choice([7, 7, draw.randrange(40), draw.randrange(40), None]), draw.randrange(50), f"t{draw.randrange(9)}") for _ in range(30)]
        assert upserts.upsert(spark, path, frame(spark, rows), "id", ["at"], 4, ("s", batch))
        assert not upserts.upsert(spark, path, frame(spark, [(1, 99, "again")]), "id", ["at"], 4, ("s", batch))
        put(want, rows)
        past.append(dict(want))
        if batch == 3:
            assert upserts.compact(spark, path, above=2) == 4
            assert {len(f) for f in upserts.manifest(spark, path)["folders"].values()} == {1}
            past.append(dict(want))
        assert held(spark, path) == want
    assert [held(spark, path, version=v) for v in upserts.versions(spark, path)] == past
    assert not upserts.upsert(spark, path, frame(spark, []), "id", ["at"], 4, ("s", 6))
    # the same number of another stream is another batch
    assert upserts.upsert(spark, path, frame(spark, [(1, 99, "other")]), "id", ["at"], 4, ("other", 0))
    assert held(spark, path)[1] == (1, 99, "other")


def test_other_buckets_id_order_or_columns_are_refused(spark, tmp_path):
    path, rows = str(tmp_path / "ix"), [(i, 1, "a") for i in range(50)]
    upserts.upsert(spark, path, frame(spark, rows), "id", ["at"], 64)
    more = frame(spark, [(3, 2, "b")])
    for args in ((more, "id", ["at"], 32), (more, "at", ["id"], 64), (more, "id", ["text"], 64), (more.drop("text"), "id", ["at"], 64)):
        with pytest.raises(ValueError):
            upserts.upsert(spark, path, *args)
    assert len(held(spark, path)) == 50


def test_a_failure_before_the_manifest_leaves_nothing_visible(spark, tmp_path, monkeypatch):
    path, arrived, checkpoint = (str(tmp_path / n) for n in ("ix", "arrived", "checkpoint"))

    def run():
        stream = spark.readStream.schema(SCHEMA).parquet(arrived)
        query = upserts.stream_upserts(stream, path, checkpoint, "id", ["at"], 2, None, above=1)
        query.awaitTermination()

    frame(spark, [(1, 1, "a"), (2, 1, "b")]).write.parquet(arrived)
    run()
    frame(spark, [(2, 2, "c"), (3, 1, "d")]).write.mode("append").parquet(arrived)
    publish = manifests.publish

    def lost(*_):
        raise OSError("the driver is gone")

    monkeypatch.setattr(manifests, "publish", lost)
    with pytest.raises(Exception, match="the driver is gone"):
        run()
    assert held(spark, path) == {1: (1, 1, "a"), 2: (2, 1, "b")}
    monkeypatch.setattr(manifests, "publish", publish)
    # the batch runs again, and once more after it was committed
    run()
    run()
    assert held(spark, path) == {1: (1, 1, "a"), 2: (2, 2, "c"), 3: (3, 1, "d")}
    assert upserts.vacuum(spark, path, keep=1, older_than=-60) > 0
    assert held(spark, path) == {1: (1, 1, "a"), 2: (2, 2, "c"), 3: (3, 1, "d")}
    assert len(upserts.versions(spark, path)) == 1


def test_two_writers_at_once_lose_nothing(spark, tmp_path, monkeypatch):
    path, publish, first = str(tmp_path / "ix"), manifests.publish, []
    upserts.upsert(spark, path, frame(spark, [(1, 1, "a"), (2, 1, "b")]), "id", ["at"], 1)
    upserts.upsert(spark, path, frame(spark, [(2, 5, "c")]), "id", ["at"], 1)

    def late(spark, path, state, version):
        # another writer commits between this one's look at the manifest and its own commit
        if not first:
            first.append(version)
            upserts.upsert(spark, path, frame(spark, [(3, 1, "d"), (1, 0, "old")]), "id", ["at"], 1)
        return publish(spark, path, state, version)

    monkeypatch.setattr(manifests, "publish", late)
    assert upserts.compact(spark, path) == 1
    assert held(spark, path) == {1: (1, 1, "a"), 2: (2, 5, "c"), 3: (3, 1, "d")}
    assert len(upserts.manifest(spark, path)["folders"]["0"]) == 2


def test_lookup_reads_only_the_buckets_of_its_ids(spark, tmp_path):
    path = str(tmp_path / "ix")
    upserts.upsert(spark, path, frame(spark, [(i, 1, f"t{i}") for i in range(500)] + [(None, 1, "none")]), "id", ["at"], 32)
    upserts.upsert(spark, path, frame(spark, [(i, 2, "new") for i in range(0, 500, 5)]), "id", ["at"], 32)
    found = upserts.lookup(spark, path, [5, 6, 10**9, None])
    assert sorted((r["text"] for r in found.collect())) == ["new", "none", "t6"]
    hit = {int(re.search(r"_bucket=(\d+)", f).group(1)) for f in found.inputFiles()}
    assert 0 < len(hit) <= 4
    plan = found._jdf.queryExecution().toString()
    assert "In(id" in plan or "id IN" in plan
    assert upserts.lookup(spark, path, []).count() == 0
    with pytest.raises(FileNotFoundError):
        upserts.read_upserts(spark, str(tmp_path / "nothing"))
