import math

import pytest
from hypothesis import Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from curbflow.functions import geo


def reference_geohash(lat, lon, precision):
    """Interval halving, the definition of a geohash."""
    lats, lons = [-90.0, 90.0], [-180.0, 180.0]
    bits, out = [], ""
    while len(out) < precision:
        interval, value = (lons, lon) if len(bits) % 2 == 0 else (lats, lat)
        middle = (interval[0] + interval[1]) / 2
        bits.append(int(value >= middle))
        interval[0 if value >= middle else 1] = middle
        if len(bits) % 5 == 0:
            out += geo.GEOHASH_ALPHABET[int("".join(map(str, bits[-5:])), 2)]
    return out


def haversine(a, b):
    la, lo, lb, lob = map(math.radians, (*a, *b))
    h = math.sin((la - lb) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((lo - lob) / 2) ** 2
    return 2 * geo.EARTH_RADIUS_M * math.asin(math.sqrt(min(1.0, h)))


def points(spark, rows):
    return spark.createDataFrame(rows, "lat double, lon double")


def test_golden_geohash(spark):
    df = points(spark, [(41.12, -71.34)])
    row = df.select(*[geo.geohash("lat", "lon", p).alias(f"p{p}") for p in range(1, 13)]).first()
    assert [row[f"p{p}"] for p in range(1, 13)] == ["drm3btev3e86"[:p] for p in range(1, 13)]


# Degrees with six digits, as data has them: a sum with 90 or 180 loses smaller fractions.
@settings(max_examples=8, deadline=None, phases=[Phase.generate])
@given(
    st.lists(
        st.tuples(
            st.integers(-90_000_000, 90_000_000).map(lambda n: n / 1e6),
            st.integers(-180_000_000, 179_999_999).map(lambda n: n / 1e6),
        ),
        min_size=20,
        max_size=40,
    ),
    st.integers(1, 12),
)
def test_geohash_is_interval_halving(spark, rows, precision):
    got = points(spark, rows).select("lat", "lon", geo.geohash("lat", "lon", precision).alias("g")).collect()
    for r in got:
        if r["lat"] < 90:
            assert r["g"] == reference_geohash(r["lat"], r["lon"], precision)


def test_geohash_edges(spark):
    rows = [(90.0, 0.0), (91.0, 0.0), (None, 0.0), (0.0, None), (10.0, 190.0), (10.0, -170.0), (float("nan"), 1.0)]
    rows += [(1.0, float("nan")), (1.0, float("inf"))]
    got = [r[0] for r in points(spark, rows).select(geo.geohash("lat", "lon", 6)).collect()]
    assert got[0] == reference_geohash(89.9999999, 0.0, 6)
    assert got[1] is None and got[2] is None and got[3] is None and got[6] is None and got[7:] == [None, None]
    assert got[4] == got[5]


def test_geohash_centre_inverts(spark):
    df = points(spark, [(41.12, -71.34), (-33.9, 151.2), (0.0, 0.0)])
    for precision in range(1, 13):
        cell = df.withColumn("g", geo.geohash("lat", "lon", precision)).withColumn("c", geo.geohash_centre("g"))
        again = cell.select("g", "c.*").withColumn("h", geo.geohash("lat", "lon", precision))
        assert all(r["g"] == r["h"] for r in again.collect())


def test_four_point_forms(spark):
    texts = [
        "40.715, -74.011",
        '"41.12,-71.34"',
        '{"lat": 40.722, "lon": -73.989}',
        "[ -73.983, 40.719 ]",
        "drm3btev3e86",
        "somewhere",
        "[1]",
        '{"lat": 1}',
        "{broken",
        "",
        None,
    ]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r["p"] for r in df.select(geo.parse_geo_point("t").alias("p")).collect()]
    want = [(40.715, -74.011), (41.12, -71.34), (40.722, -73.989), (40.719, -73.983), (41.12, -71.34)]
    for p, w in zip(got, want):
        assert (round(p["lat"], 6), round(p["lon"], 6)) == w
    assert got[5:] == [None] * 6


def test_boxes_are_strict_and_bounding_boxes_inclusive(spark):
    df = points(spark, [(40.0, -73.5), (40.5, -74.0), (40.5, -73.5), (None, -73.5)])
    assert df.filter(geo.in_box("lat", "lon", geo.BOX_C)).count() == 1
    assert df.filter(geo.in_bounding_box("lat", "lon", (41, -74.0), (40.0, -73.0))).count() == 3


def test_bounding_box_across_the_date_line(spark):
    df = points(spark, [(0.0, 179.5), (0.0, -179.5), (0.0, 0.0)])
    assert df.filter(geo.in_bounding_box("lat", "lon", (1, 179.0), (-1, -179.0))).count() == 2


@pytest.mark.parametrize("centre", [(40.74861, -73.98441), (89.95, 10.0), (0.0, 179.99), (-60.0, -179.95)])
def test_within_distance_equals_brute_force(spark, centre):
    rows = [
        (max(-90.0, min(90.0, centre[0] + i * 0.04)), (centre[1] + j * 0.05 + 540) % 360 - 180)
        for i in range(-8, 9)
        for j in range(-8, 9)
    ]
    for metres in (5_000.0, 16093.44, 40_000.0):
        got = points(spark, rows).filter(geo.within_distance("lat", "lon", centre, metres)).collect()
        want = [r for r in rows if haversine(r, centre) <= metres]
        assert sorted(map(tuple, got)) == sorted(want)


def test_missing_coordinate_has_no_distance(spark):
    df = points(spark, [(None, 1.0), (1.0, None)])
    assert [r[0] for r in df.select(geo.haversine_m("lat", "lon", (0.0, 0.0))).collect()] == [None, None]


def test_precision_for_zoom():
    assert [geo.precision_for_zoom(z) for z in (0, 2, 5, 13, 16, 20)] == [1, 2, 3, 6, 7, 7]
