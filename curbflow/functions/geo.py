"""Geohash cells, distances, boxes and geo-point parsing as column expressions."""

from __future__ import annotations

import math
import sys
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The geohash alphabet and the plain base-32 digits in the same order.
GEOHASH_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"
BASE32_DIGITS = "0123456789abcdefghijklmnopqrstuv"

# Mean earth radius and the international mile, in metres.
EARTH_RADIUS_M = 6371008.7714
MILE_M = 1609.344


@dataclass(frozen=True)
class Box:
    """A box in degrees; whether the edges belong to it is up to the predicate."""

    south: float
    north: float
    west: float
    east: float


# The three box presets.
BOX_A = Box(39.0, 41.0, -75.0, -73.0)
BOX_B = Box(40.0, 42.0, -75.0, -73.0)
BOX_C = Box(40.0, 41.0, -74.0, -73.0)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def has_numbers(columns: list[Column | str]) -> Column:
    """Every column holds a finite number: neither null, nor NaN, nor infinite.

    NaN sorts above all numbers, so the two comparisons test all of it, and Spark derives the null
    test that reaches the scan from them. A condition is copied below the projections that compute
    its columns, and short ones keep the generated method small enough to be compiled.
    """
    clauses = [_col(c).between(F.lit(-sys.float_info.max), F.lit(sys.float_info.max)) for c in columns]
    return reduce(lambda a, b: a & b, clauses)


def in_box(lat: Column | str, lon: Column | str, box: Box) -> Column:
    """Strictly inside the box."""
    lat, lon = _col(lat), _col(lon)
    return (lat > box.south) & (lat < box.north) & (lon > box.west) & (lon < box.east)


def in_bounding_box(
    lat: Column | str, lon: Column | str, top_left: tuple[float, float], bottom_right: tuple[float, float]
) -> Column:
    """Inside or on the edge of the box given by two (lat, lon) corners.

    A box whose left edge lies east of its right edge crosses the date line.
    """
    lat, lon = _col(lat), _col(lon)
    top, left = top_left
    bottom, right = bottom_right
    within_lon = lon.between(left, right) if left <= right else (lon >= left) | (lon <= right)
    return lat.between(bottom, top) & within_lon


def haversine_m(lat: Column | str, lon: Column | str, centre: tuple[float, float]) -> Column:
    """Great-circle distance in metres on the mean-radius sphere."""
    lat, lon = F.radians(_col(lat)), F.radians(_col(lon))
    lat0, lon0 = math.radians(centre[0]), math.radians(centre[1])
    half_dlat = F.sin((lat - F.lit(lat0)) / 2)
    half_dlon = F.sin((lon - F.lit(lon0)) / 2)
    h = half_dlat * half_dlat + F.cos(lat) * F.lit(math.cos(lat0)) * half_dlon * half_dlon
    # not least(): that would turn the null of a missing coordinate into a distance
    return F.asin(F.sqrt(F.when(h > 1, 1.0).otherwise(h))) * F.lit(2 * EARTH_RADIUS_M)


def circle_box(centre: tuple[float, float], metres: float) -> tuple[float, float, tuple[float, float] | None]:
    """South, north and (west, east) of a box around a circle; no sides where it holds a pole or
    crosses the date line."""
    # a hair wider than the circle, so that rounding never drops a point on its edge
    angle = metres / EARTH_RADIUS_M * (1 + 1e-9) + 1e-12
    south, north = centre[0] - math.degrees(angle), centre[0] + math.degrees(angle)
    if south <= -90 or north >= 90:
        return south, north, None
    reach = math.degrees(math.asin(min(1.0, math.sin(angle) / math.cos(math.radians(centre[0])))))
    west, east = centre[1] - reach, centre[1] + reach
    return south, north, (west, east) if west >= -180 and east <= 180 else None


def within_distance(
    lat: Column | str, lon: Column | str, centre: tuple[float, float], metres: float
) -> Column:
    """At most ``metres`` from ``centre``.

    A latitude/longitude box goes first: it is cheap, it reaches the scan when the
    coordinates are stored columns, and it can only drop points beyond the radius.
    """
    lat, lon = _col(lat), _col(lon)
    south, north, sides = circle_box(centre, metres)
    near = lat.between(south, north)
    if sides:
        near = near & lon.between(*sides)
    return near & (haversine_m(lat, lon, centre) <= metres)


def axis_bits(precision: int) -> tuple[int, int]:
    """(latitude bits, longitude bits) of a geohash; longitude takes the first bit."""
    if not 1 <= precision <= 12:
        raise ValueError("geohash precision must be 1 to 12")
    total = 5 * precision
    return total // 2, total - total // 2


def _cell_sql(lat: str, lon: str, precision: int) -> tuple[str, str]:
    lat_bits, lon_bits = axis_bits(precision)
    rows, columns = 1 << lat_bits, 1 << lon_bits
    # at most 30 bits each, so plain integers hold them
    row = f"least(CAST(floor(({lat} + 90) / 180 * {rows}.0D) AS INT), {rows - 1})"
    finite = f"abs({lon}) < double('Infinity')"
    row = f"CASE WHEN {lat} >= -90 AND {lat} <= 90 AND {finite} THEN {row} END"
    column = f"CAST(pmod(floor(({lon} + 180) / 360 * {columns}.0D), {columns}L) AS INT)"
    return row, column


def geohash_cell(lat: str, lon: str, precision: int) -> tuple[Column, Column]:
    """Integer (row, column) of the geohash cell: the form to group and join on.

    Takes columns by name or SQL text. Latitudes beyond the poles and longitudes that are no
    finite number give a null row; other longitudes wrap around the date line.
    """
    row, column = _cell_sql(lat, lon, precision)
    return F.expr(row), F.expr(column)


def _letters() -> str:
    """The alphabet by (three bits of one axis, two bits of the other), as letters mix them."""

    def mixed(three: int, two: int) -> int:
        bits = [three >> 2 & 1, two >> 1 & 1, three >> 1 & 1, two & 1, three & 1]
        return int("".join(map(str, bits)), 2)

    return "".join(GEOHASH_ALPHABET[mixed(three, two)] for three in range(8) for two in range(4))


def _text_sql(row: str, column: str, precision: int) -> str:
    """Each letter takes three bits from one axis and two from the other, in turns."""
    row_left, column_left = axis_bits(precision)
    letters = _letters()
    parts = []
    for place in range(precision):
        if place % 2 == 0:
            column_left, row_left = column_left - 3, row_left - 2
            three, two = f"shiftright({column}, {column_left})", f"shiftright({row}, {row_left})"
        else:
            column_left, row_left = column_left - 2, row_left - 3
            three, two = f"shiftright({row}, {row_left})", f"shiftright({column}, {column_left})"
        at = f"(shiftleft({three} & 7, 2) | {two} & 3) + 1"
        parts.append(f"substring('{letters}', {at}, 1)")
    return f"concat({', '.join(parts)})"


def geohash_text(row: str, column: str, precision: int) -> Column:
    """The geohash of an integer cell."""
    return F.expr(_text_sql(row, column, precision))


def geohash(lat: str, lon: str, precision: int = 8) -> Column:
    """Geohash of a point; null when a coordinate is null.

    The expression is one SQL text: building it call by call would take longer than a batch.
    """
    row, column = _cell_sql(lat, lon, precision)
    return F.expr(_text_sql(f"({row})", f"({column})", precision))


def geohash_centre(cell: Column | str) -> Column:
    """``struct(lat, lon)`` of the middle of a geohash of 1 to 12 letters, else null."""
    cell = F.lower(_col(cell))
    valid = cell.rlike(f"^[{GEOHASH_ALPHABET}]{{1,12}}$")
    digits = F.translate(cell, GEOHASH_ALPHABET, BASE32_DIGITS)
    # all letters as one integer of at most 60 bits, from which both axes are taken bit by bit
    bits = F.when(valid, F.conv(digits, 32, 10)).cast("bigint")
    return F.transform(F.array(F.struct(bits.alias("b"), F.length(cell).alias("n"))), _cell_middle)[0]


def _every_other(bits: Column) -> Column:
    """Bits 0, 2, 4, ... of a non-negative integer, moved together in five steps."""
    bits = bits.bitwiseAND(F.lit(0x5555555555555555))
    for shift, mask in (
        (1, 0x3333333333333333),
        (2, 0x0F0F0F0F0F0F0F0F),
        (4, 0x00FF00FF00FF00FF),
        (8, 0x0000FFFF0000FFFF),
        (16, 0x00000000FFFFFFFF),
    ):
        bits = bits.bitwiseOR(F.shiftright(bits, shift)).bitwiseAND(F.lit(mask))
    return bits


def _cell_middle(cell: Column) -> Column:
    """``struct(lat, lon)`` of the bits ``b`` of ``n`` letters; longitude has the first bit."""
    total = cell["n"] * 5
    odd = total % 2  # with an odd number of bits the last one is longitude's
    low, high = _every_other(cell["b"]), _every_other(F.shiftright(cell["b"], 1))
    lat, lon = F.when(odd == 1, high).otherwise(low), F.when(odd == 1, low).otherwise(high)

    def middle(index: Column, count: Column, least: float, span: float) -> Column:
        return F.lit(least) + (index + F.lit(0.5)) * F.lit(span) / F.pow(F.lit(2.0), count)

    lat_bits = F.shiftright(total, 1)
    place = F.struct(
        middle(lat, lat_bits, -90.0, 180.0).alias("lat"), middle(lon, total - lat_bits, -180.0, 360.0).alias("lon")
    )
    return F.when(cell["b"].isNotNull(), place)


def parse_geo_point(text: Column | str) -> Column:
    """``struct(lat, lon)`` from any of the four encodings of a geo point.

    ``{"lat":..,"lon":..}``, ``[lon, lat]``, ``"lat,lon"`` or a geohash. The shape of the
    text picks the decoder, so each row runs only one of them.
    """
    text = F.btrim(_col(text))
    pair = F.split(F.btrim(text, F.lit('[]" ')), ",")
    # numbers may come as text, each in its own quotes
    first, second = (F.btrim(F.get(pair, i), F.lit('" ')).try_cast("double") for i in (0, 1))
    two, bracket = F.size(pair) == 2, text.startswith("[")
    parsed = (
        F.when(text.startswith("{"), F.struct(*[F.get_json_object(text, f"$.{c}").try_cast("double").alias(c) for c in ("lat", "lon")]))
        .when(two & bracket & text.endswith("]"), F.struct(second.alias("lat"), first.alias("lon")))
        .when(two & ~bracket, F.struct(first.alias("lat"), second.alias("lon")))
        .otherwise(geohash_centre(F.btrim(text, F.lit('"'))))
    )
    # one test of the outcome, so that no branch is computed once for the test and once for use
    return F.when(has_numbers([parsed["lat"], parsed["lon"]]), parsed)


def precision_for_zoom(zoom: int, finest: int = 7, least_pixels: int = 16) -> int:
    """The finest grid whose cells are at least ``least_pixels`` wide at a map zoom level."""
    world_pixels = 256 * 2**zoom
    fitting = [p for p in range(1, finest + 1) if world_pixels / 2 ** axis_bits(p)[1] >= least_pixels]
    return max(fitting, default=1)
