import math
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from curbflow.operators import cluster as c
from curbflow.operators.metrics import supply_demand, vendor_pair_counts, with_centres


def frame(spark, rows):
    return spark.createDataFrame(rows, "lat double, lon double")


def cloud(n, seed=1):
    draw = random.Random(seed)
    return [(40 + draw.random(), -74 + draw.random()) for _ in range(n)]


def brute(point, centres):
    return min(range(len(centres)), key=lambda i: sum((a - b) ** 2 for a, b in zip(point, centres[i])))


@pytest.mark.parametrize("k", [1, 2, 8, 32, 33, 64, 65, 150, 300])
def test_nearest_centre_equals_brute_force(spark, k):
    centres = c.given_centres(cloud(k, seed=k))
    rows = cloud(300)
    got = c.assign_clusters(frame(spark, rows), centres).collect()
    assert len(got) == 300
    assert all(r["cluster"] == brute((r["lat"], r["lon"]), centres.coords) for r in got)


def test_ties_go_to_the_lowest_cluster_and_missing_points_to_none(spark):
    centres = c.given_centres([(0.0, 1.0), (0.0, -1.0)])
    df = frame(spark, [(0.0, 0.0), (None, 0.0), (0.0, None), (float("nan"), 0.0), (float("inf"), 0.0), (0.0, float("-inf"))])
    assert [r["cluster"] for r in c.assign_clusters(df, centres).collect()] == [0]


@pytest.mark.parametrize("unit,decay", [("batches", 0.87), ("batches", 1.0), ("points", 0.999)])
def test_updates_match_the_library_model(spark, unit, decay):
    from pyspark.mllib.clustering import StreamingKMeansModel
    from pyspark.mllib.linalg import Vectors

    start = [(40.2, -73.8), (40.8, -73.2), (40.2, -73.2), (40.8, -73.8)]
    ours = c.given_centres(start, 1.0)
    theirs = StreamingKMeansModel([list(x) for x in start], [1.0] * 4)
    for batch in range(3):
        rows = cloud(200, seed=batch)
        ours = c.train_batch(frame(spark, rows), ours, decay, unit)
        rdd = spark.sparkContext.parallelize([Vectors.dense(r) for r in rows], 4)
        theirs = theirs.update(rdd, decay, unit)
        assert np.allclose(ours.coords, [list(x) for x in theirs.centers], atol=1e-10)
        assert np.allclose(ours.weights, list(theirs.clusterWeights), atol=1e-9)


def test_dying_cluster_is_revived_beside_the_heaviest():
    model = c.Centres(((2.0, 3.0), (50.0, 50.0)), (0.0, 0.0))
    sums = [{"cluster": 0, "n": 4, "sum_lat": 8.0, "sum_lon": 12.0}]
    after = c.update_centres(model, sums, 1.0)
    assert after.weights == (2.0, 2.0)
    assert after.coords[0] == (2.0 + 2e-14, 3.0 + 3e-14)
    assert after.coords[1] == (2.0 - 2e-14, 3.0 - 3e-14)


def test_cluster_without_points_still_fades():
    model = c.given_centres([(0.0, 0.0), (9.0, 9.0)], 1.0)
    after = c.update_centres(model, [{"cluster": 0, "n": 1, "sum_lat": 1.0, "sum_lon": 1.0}], 0.5)
    assert after.coords == ((1 / 1.5, 1 / 1.5), (9.0, 9.0))
    assert after.weights == (1.5, 0.5)


def test_half_life():
    assert math.isclose(c.half_life_decay(5) ** 5, 0.5)


def test_random_centres():
    model = c.random_centres(seed=0)
    assert (model.k, len(model.coords[0]), set(model.weights)) == (8, 2, {0.0})
    assert model == c.random_centres(seed=0) != c.random_centres(seed=1)
    with pytest.raises(ValueError):
        c.Centres((), ())


def test_random_start_ends_inside_the_data(spark):
    model = c.random_centres(seed=3)
    for batch in range(10):
        model = c.train_batch(frame(spark, cloud(300, seed=batch)), model, c.half_life_decay(5))
    assert all(40 <= lat <= 41 and -74 <= lon <= -73 for lat, lon in model.coords)


def timed(spark, rows, kind):
    df = spark.createDataFrame(rows, "id long, ts string, lat double, lon double")
    return df.withColumn("ts", df.ts.cast(kind))


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_fold_and_history_in_any_time_zone(spark, kind, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        every = timedelta(hours=6)
        begin = datetime(2024, 1, 1, 0)
        # nothing in the third window
        hours = [0, 1, 5, 6, 7, 11, 18, 19, 23]
        points = cloud(len(hours), seed=5)
        rows = [(i, str(begin + timedelta(hours=h)), *p) for i, (h, p) in enumerate(zip(hours, points))]
        df = timed(spark, rows, kind)
        start = c.given_centres([(40.2, -73.8), (40.8, -73.2)])
        history = list(c.train_windows(df, start, every, 0.5))
        model, want = start, []
        for w in range(4):
            inside = [p for h, p in zip(hours, points) if w * 6 <= h < w * 6 + 6]
            groups = {}
            for p in inside:
                groups.setdefault(brute(p, model.coords), []).append(p)
            sums = [
                {"cluster": k, "n": len(g), "sum_lat": sum(p[0] for p in g), "sum_lon": sum(p[1] for p in g)}
                for k, g in groups.items()
            ]
            model = c.update_centres(model, sums, 0.5)
            want.append(model)
        # windows align to the epoch, which local wall-clock time may be shifted from
        offsets = {(s - begin).total_seconds() % every.total_seconds() for s, _ in history}
        assert len(offsets) == 1
        if offsets == {0.0}:
            assert [s for s, _ in history] == [begin + every * w for w in range(4)]
            for (_, got), expected in zip(history, want):
                assert np.allclose(got.coords, expected.coords) and np.allclose(got.weights, expected.weights)
        assigned = c.assign_with_history(df, c.history_df(spark, history), 2, every).collect()
        models = dict(history)
        assert len(assigned) == len(rows)
        for r in assigned:
            assert r["cluster"] == brute((r["lat"], r["lon"]), models[r["batch"]].coords)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def assigned(spark, rows):
    return spark.createDataFrame(rows, "batch int, topic string, vendor_id double, cluster int")


def test_vendor_pairs_equal_the_real_join(spark):
    draw = random.Random(2)
    rows = [
        (draw.randrange(3), draw.choice(["users", "cars"]), float(draw.choice([1, 1, 2])), draw.randrange(4))
        for _ in range(400)
    ]
    want = {}
    for b, t, vendor, _ in rows:
        if vendor == 1.0:
            for b2, t2, _, k in rows:
                if (b2, t2) == (b, t):
                    want[(b, t, k)] = want.get((b, t, k), 0) + 1
    got = vendor_pair_counts(assigned(spark, rows), ["batch"]).collect()
    assert {(r["batch"], r["topic"], r["cluster"]): r["pairs"] for r in got} == want


def test_ratio_inner_and_outer(spark):
    rows = [(0, "users", 1.0, 0)] * 3 + [(0, "cars", 1.0, 0)] * 2 + [(0, "users", 1.0, 1), (0, "cars", 1.0, 2)]
    df = assigned(spark, rows + [(0, "users", 1.0, None)])
    inner = supply_demand(df).collect()
    assert [(r["cluster"], r["u_count"], r["c_count"], r["ratio"]) for r in inner] == [(0, 3, 2, 1.5)]
    outer = {r["cluster"]: r["ratio"] for r in supply_demand(df, how="outer").collect()}
    assert outer == {0: 1.5, 1: None, 2: 0.0}
    placed = with_centres(supply_demand(df), c.given_centres([(1.0, 2.0), (3.0, 4.0)])).collect()
    assert [(r["lat"], r["lon"]) for r in placed] == [(1.0, 2.0)]


def test_centres_round_trip(spark):
    model = c.Centres(((1.5, -2.5), (1e-14, 1e20)), (0.25, 3.0))
    assert c.Centres.from_rows(model.to_df(spark).collect()) == model
    assert model.to_df(spark).count() == model.k


def test_windows_without_a_model_of_their_own_take_the_nearest_earlier_one(spark):
    rows = [(h, 40.0 + h / 100, -74.0) for h in (1, 7, 20)]
    df = spark.createDataFrame(rows, "h int, lat double, lon double").selectExpr(
        "lat", "lon", "h", "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, h) AS ts"
    )
    start, every = c.given_centres([(40.0, -74.0), (10.0, 10.0)]), timedelta(hours=6)
    trained = c.given_centres([(10.0, 10.0), (40.0, -74.0)])
    history = c.history_df(spark, [(datetime(2024, 1, 1, 6), trained)])
    got = c.assign_with_history(df, history, 2, every, start=start).collect()
    assert {r["h"]: r["cluster"] for r in got} == {1: 0, 7: 1, 20: 1}
    got = c.assign_with_history(df, history, 2, every, predict_first=True, start=start).collect()
    assert {r["h"]: r["cluster"] for r in got} == {1: 0, 7: 0, 20: 1}


def test_empty_windows_cost_no_job(spark):
    df = spark.createDataFrame([(1.0, 1.0, "2024-01-01 00:00:00"), (1.0, 1.0, "2024-01-01 00:05:00")], "lat double, lon double, t string")
    df = df.withColumn("ts", F.col("t").cast("timestamp_ntz"))
    tracker, group = spark.sparkContext.statusTracker(), "empty-windows"
    spark.sparkContext.setJobGroup(group, group)
    history = list(c.train_windows(df, c.given_centres([(0.0, 0.0)]), timedelta(seconds=5), 0.5))
    jobs = tracker.getJobIdsForGroup(group)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(history) == 61 and len(jobs) <= 8
    assert history[1][1].weights == (0.5,)


@pytest.mark.parametrize("kind", ["spread", "line", "clumped", "one place"])
def test_many_centres_by_cell(spark, kind):
    """Points near, between and far beyond many centres get the nearest of all, ties to the lowest."""
    rng = np.random.default_rng(4)
    k = 700
    coords = {
        "spread": rng.normal(size=(k, 2)) * [1.0, 30.0],
        "line": np.stack([np.round(rng.uniform(0, 9, k), 1), np.full(k, 5.0)], axis=1),
        "clumped": np.concatenate([rng.normal(size=(k - 3, 2)) * 1e-4, [[50, 50], [-80, 3], [1e3, 1e3]]]),
        "one place": np.full((k, 2), 2.5),
    }[kind]
    points = np.concatenate([coords[:300], coords[:300] + rng.normal(size=(300, 2)) * 0.01, rng.normal(size=(500, 2)) * 40, rng.normal(size=(200, 2)) * 1e5, [[1e300, 0], [0, -1e300]]])
    points = np.concatenate([points, np.round(points, 1)[:600]])
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)], "id int, lat double, lon double")
    centres = c.given_centres([tuple(map(float, x)) for x in coords])
    got = {r["id"]: r["cluster"] for r in c.assign_clusters(df, centres).collect()}
    with np.errstate(over="ignore"):
        d = (points[:, None, 0] - coords[None, :, 0]) ** 2 + (points[:, None, 1] - coords[None, :, 1]) ** 2
    assert got == dict(enumerate(d.argmin(1).tolist()))


def test_candidates_do_not_grow_with_centres():
    sizes = {}
    for k in (400, 6400):
        coords = np.random.default_rng(1).uniform(size=(k, 2))
        (axis, _), table = c._cells(coords)
        counts = np.array([len(x) for x in table["_candidates"][1:]])
        at = np.array(table["_cell"][1:])
        inside = [(v >= axis.rings) & (v < axis.rings + axis.cells) for v in (at // axis.span, at % axis.span)]
        sizes[k] = counts[inside[0] & inside[1]].mean()
    assert sizes[6400] < 1.2 * sizes[400] < 20
