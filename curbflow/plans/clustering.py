"""Online k-means steps and folds."""

from __future__ import annotations

import math
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.operators import cluster as c
from curbflow.plans import common

EVERY = timedelta(days=5)
DECAY = c.half_life_decay(c.DEFAULT_HALF_LIFE)
SQL_DECAY = f"{DECAY!r}e0"
START_WEIGHT = 10.0
POINT_DECAY = 0.9999
RANDOM_SEED = 7
MANY = [(39.5 + i * 0.13, -74.5 + j * 0.11) for i in range(15) for j in range(20)]
MORE = [(39.5 + i * 0.0195, -74.5 + j * 0.022) for i in range(100) for j in range(100)]
# The SQL has a block of entries for each window; it raises an error on longer data.
SQL_WINDOWS = 8
SQL_BATCH_NUMBER = f"CAST(floor(epoch(ts) / {EVERY.days * 86400}) AS BIGINT)"


def batch_number(ts: str) -> Column:
    """The number of the five-day window that holds ``ts``, counted from the epoch."""
    return F.floor(F.unix_timestamp(F.col(ts).cast("timestamp")) / (EVERY.days * 86400))


def _users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return common.points(spark, sf_dir).filter("topic = 'users'")


def _rounded(model: DataFrame) -> DataFrame:
    return model.select(
        *[x for x in model.columns if x not in ("lat", "lon", "weight", "batch")],
        *[F.date_format("batch", "yyyy-MM-dd").alias("batch") for x in model.columns if x == "batch"],
        F.round("lat", 6).alias("lat"),
        F.round("lon", 6).alias("lon"),
        F.round("weight", 6).alias("weight"),
    )


def _step(spark: SparkSession, sf_dir: str, decay: float, unit: str = "batches") -> DataFrame:
    model = c.train_batch(_users(spark, sf_dir), common.centres(START_WEIGHT), decay, unit)
    return _rounded(model.to_df(spark))


def cluster_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vector sum and count of each cluster."""
    sums = c.cluster_sums(_users(spark, sf_dir), common.centres())
    return sums.select("cluster", "n", F.round("sum_lat", 4).alias("sum_lat"), F.round("sum_lon", 4).alias("sum_lon"))


def kmeans_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points by the nearest of 300 centres on a grid."""
    assigned = c.assign_clusters(common.points(spark, sf_dir), c.given_centres(MANY))
    return assigned.select("trip_id", "cluster")


def kmeans_thousands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points by the nearest of 10,000 centres on a grid."""
    assigned = c.assign_clusters(common.points(spark, sf_dir), c.given_centres(MORE))
    return assigned.select("trip_id", "cluster")


def kmeans_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One update of the centres by all user points as one batch."""
    return _step(spark, sf_dir, DECAY)


def kmeans_no_decay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _step(spark, sf_dir, 1.0)


def kmeans_point_decay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old weights fade with every point instead of every batch."""
    return _step(spark, sf_dir, POINT_DECAY, "points")


def _fold(spark: SparkSession, sf_dir: str) -> list:
    return list(c.train_windows(_users(spark, sf_dir), common.centres(), EVERY, DECAY))


def kmeans_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model after each five-day batch."""
    return _rounded(c.history_df(spark, _fold(spark, sf_dir)))


def _assigned_in_turn(spark: SparkSession, sf_dir: str, predict_first: bool) -> DataFrame:
    history = c.history_df(spark, _fold(spark, sf_dir))
    points = common.points(spark, sf_dir).select("trip_id", "topic", "ts", "lat", "lon")
    start = common.centres()
    assigned = c.assign_with_history(points, history, start.k, EVERY, predict_first=predict_first, start=start)
    return assigned.select("trip_id", F.date_format("batch", "yyyy-MM-dd").alias("batch"), "cluster")


def trained_then_assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each batch assigned by the model that has just learned it."""
    return _assigned_in_turn(spark, sf_dir, predict_first=False)


def assigned_then_trained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each batch assigned by the model before it; the first batch by the start model."""
    return _assigned_in_turn(spark, sf_dir, predict_first=True)


def random_start_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight random centres folded over the batches: what must hold whatever the start.

    Clusters that come alive by splitting differ by rounding alone, so single centres are not
    comparable between engines; their number and the total weight are.
    """
    users = _users(spark, sf_dir)
    start = c.random_centres(seed=RANDOM_SEED)
    rows = [
        (batch.strftime("%Y-%m-%d"), model.k, round(math.fsum(model.weights), 4))
        for batch, model in c.train_windows(users, start, EVERY, DECAY)
    ]
    return spark.createDataFrame(rows, "batch STRING, centres INT, total_weight DOUBLE")


QUERIES = {
    f.__name__: f
    for f in (
        cluster_sums,
        kmeans_many,
        kmeans_thousands,
        kmeans_step,
        kmeans_no_decay,
        kmeans_point_decay,
        kmeans_fold,
        trained_then_assigned,
        assigned_then_trained,
        random_start_invariants,
    )
}

_USERS = "users AS (SELECT * FROM assigned WHERE topic = 'users')"
_SUMS = """sums AS (SELECT cluster, count(*) AS n, sum(lat) AS slat, sum(lon) AS slon
  FROM users GROUP BY cluster)"""


def _sql_step(decay: str) -> str:
    faded = f"({START_WEIGHT}e0 * {decay})"
    return f"""WITH {common.SQL_ASSIGNED}, {_USERS}, {_SUMS}
SELECT CAST(c.cluster AS INTEGER) AS cluster,
  round((clat * {faded} + coalesce(slat, 0)) / ({faded} + coalesce(n, 0)), 6) AS lat,
  round((clon * {faded} + coalesce(slon, 0)) / ({faded} + coalesce(n, 0)), 6) AS lon,
  round({faded} + coalesce(n, 0), 6) AS weight
FROM centres c LEFT JOIN sums s USING (cluster)"""


def _sql_fold() -> str:
    """The fold, one block of WITH entries per window, and ``history`` of all models."""
    blocks = [
        common.SQL_POINTS,
        common.sql_centres(),
        f"placed AS (SELECT *, {SQL_BATCH_NUMBER} AS b FROM points)",
        "users AS (SELECT * FROM placed WHERE topic = 'users')",
        "edge AS (SELECT min(b) AS lo, max(b) AS hi FROM users)",
        "m0 AS (SELECT cluster, clat, clon, 0.0e0 AS w FROM centres)",
    ]
    for i in range(1, SQL_WINDOWS + 1):
        blocks.append(f"u{i} AS (SELECT u.* FROM users u, edge WHERE u.b = edge.lo + {i - 1})")
        blocks.append(common.sql_assign(f"u{i}", f"m{i - 1}", f"a{i}"))
        blocks.append(
            f"s{i} AS (SELECT cluster, count(*) AS n, sum(lat) AS slat, sum(lon) AS slon FROM a{i} GROUP BY cluster)"
        )
        mean = "CASE WHEN n > 0 THEN (m.{c} * m.w * {d} + s.s{s}) / (m.w * {d} + n) ELSE m.{c} END"
        blocks.append(
            f"m{i} AS MATERIALIZED (SELECT cluster, {mean.format(c='clat', s='lat', d=SQL_DECAY)} AS clat,"
            f" {mean.format(c='clon', s='lon', d=SQL_DECAY)} AS clon,"
            f" m.w * {SQL_DECAY} + coalesce(n, 0) AS w FROM m{i - 1} m LEFT JOIN s{i} s USING (cluster))"
        )
    union = " UNION ALL ".join(
        f"SELECT edge.lo + {i - 1} AS b, m{i}.* FROM m{i}, edge WHERE edge.lo + {i - 1} <= edge.hi"
        for i in range(1, SQL_WINDOWS + 1)
    )
    blocks.append(
        "history AS (SELECT h.* FROM (" + union + ") h, edge WHERE CASE WHEN edge.hi - edge.lo >= "
        f"{SQL_WINDOWS} THEN error('more windows than this SQL has') ELSE TRUE END)"
    )
    return ", ".join(blocks)


def _sql_batch(b: str) -> str:
    return f"strftime(make_timestamp(CAST({b} AS BIGINT) * {EVERY.days * 86400} * 1000000), '%Y-%m-%d')"


SQL_LIVE_MODELS = f"""WITH {_sql_fold()} SELECT CAST(h.b - edge.lo AS INTEGER) AS batch, CAST(cluster AS INTEGER) AS cluster,
  round(clat, 6) AS lat, round(clon, 6) AS lon, round(w, 6) AS weight FROM history h, edge"""

SQL_BATCH_RATIOS = f"""WITH {_sql_fold()}, {common.sql_assign('placed', 'history', 'result', 'p.b = c.b')},
counted AS (SELECT b, cluster, count(*) FILTER (topic = 'users') AS u_count, count(*) FILTER (topic = 'cars') AS c_count
  FROM result GROUP BY ALL)
SELECT CAST(b - lo AS INTEGER) AS batch, CAST(cluster AS INTEGER) AS cluster, u_count, c_count,
  round(u_count / c_count, 6) AS ratio FROM counted, edge WHERE u_count > 0 AND c_count > 0"""


def _sql_assigned_in_turn(shift: int) -> str:
    on = f"greatest(least(p.b - {shift}, (SELECT hi FROM edge)), (SELECT lo FROM edge) - 1) = c.b"
    models = """models AS (SELECT b, cluster, clat, clon FROM history
  UNION ALL SELECT lo - 1 AS b, cluster, clat, clon FROM m0, edge)"""
    return f"""WITH {_sql_fold()}, {models}, {common.sql_assign('placed', 'models', 'result', on)}
SELECT trip_id, {_sql_batch('b')} AS batch, CAST(cluster AS INTEGER) AS cluster FROM result"""


ORACLES = {
    "cluster_sums": f"""WITH {common.SQL_ASSIGNED}, {_USERS}, {_SUMS}
SELECT CAST(cluster AS INTEGER) AS cluster, n, round(slat, 4) AS sum_lat, round(slon, 4) AS sum_lon FROM sums""",
    "kmeans_many": f"""WITH {common.SQL_POINTS}, {common.sql_centres(MANY)}, {common.sql_assign('points', 'centres', 'assigned')}
SELECT trip_id, CAST(cluster AS INTEGER) AS cluster FROM assigned""",
    "kmeans_thousands": f"""WITH {common.SQL_POINTS}, {common.sql_centres(MORE)}, {common.sql_assign('points', 'centres', 'assigned')}
SELECT trip_id, CAST(cluster AS INTEGER) AS cluster FROM assigned""",
    "kmeans_step": _sql_step(SQL_DECAY),
    "kmeans_no_decay": _sql_step("1.0e0"),
    "kmeans_point_decay": _sql_step(f"pow({POINT_DECAY}e0, (SELECT sum(n) FROM sums))"),
    "kmeans_fold": f"""WITH {_sql_fold()}
SELECT {_sql_batch('b')} AS batch, CAST(cluster AS INTEGER) AS cluster, round(clat, 6) AS lat,
  round(clon, 6) AS lon, round(w, 6) AS weight FROM history""",
    "trained_then_assigned": _sql_assigned_in_turn(0),
    "assigned_then_trained": _sql_assigned_in_turn(1),
    "random_start_invariants": f"""WITH {common.SQL_POINTS},
counted AS (SELECT {SQL_BATCH_NUMBER} AS b, count(*) AS n FROM points WHERE topic = 'users' GROUP BY 1),
batches AS (SELECT unnest(generate_series(min(b), max(b))) AS b FROM counted)
SELECT {_sql_batch('x.b')} AS batch, {c.DEFAULT_K} AS centres,
  round(sum(e.n * pow({SQL_DECAY}, x.b - e.b)), 4) AS total_weight
FROM batches x JOIN counted e ON e.b <= x.b GROUP BY x.b""",
}
