import random

import pytest
from pyspark.sql import functions as F

from placetally.functions import geohash, geometry, sphere
from placetally.operators import spatial
from tests.conftest import rows

# lon, lat, x, y
KNOWN = [
    (-122.61016845703124, 45.52559248776561, -2051686.120, 1026291.794),
    (-122.61016845703124, 45.694669843547246, -2046280.901, 1044289.529),
    (-122.61291503906249, 46.1665167159516, -2031399.286, 1094580.096),
]


def points(spark, pairs):
    return spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(pairs)], "id int, lon double, lat double")


def bisected(lon, lat, precision):
    """Cell id and centre by halving intervals; an edge belongs to the lower half."""
    spans = [[-180.0, 180.0], [-90.0, 90.0]]
    bits = []
    for i in range(5 * precision):
        value, span = (lon, lat)[i % 2], spans[i % 2]
        middle = sum(span) / 2
        upper = value > middle
        bits.append(upper)
        span[0 if upper else 1] = middle
    digits = [sum(b << (4 - k) for k, b in enumerate(bits[i:i + 5])) for i in range(0, len(bits), 5)]
    return "".join(geohash.ALPHABET[d] for d in digits), sum(spans[0]) / 2, sum(spans[1]) / 2


def test_known_cells(spark):
    df = points(spark, [(10.40744, 57.64911), (-5.6, 42.6)])
    assert rows(spatial.with_cell(df, precision=11).select("cell")) == [("ezs42e44yx9",), ("u4pruydqqvj",)]
    assert rows(spatial.with_cell(df, precision=5).select("cell")) == [("ezs42",), ("u4pru",)]


@pytest.mark.parametrize("precision, decimals", [(7, 2), (8, 3)])
def test_cells_and_snapping(spark, precision, decimals):
    rng = random.Random(1)
    pairs = [(rng.uniform(-180, 180), rng.uniform(-90, 90)) for _ in range(500)]
    pairs += [(0, 0), (-180, -90), (180, 90), (-90, 45), (-122.5, 45.5), (200, 95), (-200, -95)]
    df = spatial.with_cell(points(spark, pairs), precision=precision)
    df = spatial.with_snapped(df, precision=precision)
    df = spatial.with_snapped(df, precision=precision, snap="center", names=("c_lon", "c_lat"))
    for row, (lon, lat) in zip(df.orderBy("id").collect(), pairs):
        cell, c_lon, c_lat = bisected(lon, lat, precision)
        assert row.cell == cell
        assert (row.c_lon, row.c_lat) == pytest.approx((c_lon, c_lat), abs=1e-12)
        assert row.cell_lon == float(f"{c_lon:.{decimals}f}")
        assert row.cell_lat == float(f"{c_lat:.{decimals}f}")


def test_snap_modes(spark):
    df = spatial.with_snapped(points(spark, [(-122.51234, 45.51234)]), snap="exact")
    assert rows(df.select("cell_lon", "cell_lat")) == [(-122.51234, 45.51234)]
    with pytest.raises(ValueError):
        spatial.with_snapped(df, snap="nearest")


def test_null_point_has_no_cell(spark):
    df = spark.createDataFrame([(None, 1.0)], "lon double, lat double")
    row = spatial.with_cell(spatial.with_snapped(df)).first()
    assert row.cell is None and row.cell_lon is None and row.cell_lat is not None


def test_projection(spark):
    df = spatial.with_projected(points(spark, [k[:2] for k in KNOWN]))
    for row, (_, _, x, y) in zip(df.orderBy("id").collect(), KNOWN):
        assert (row.x, row.y) == pytest.approx((x, y), abs=1e-3)


def test_projection_round_trip(spark):
    rng = random.Random(2)
    df = points(spark, [(rng.uniform(-125, -66), rng.uniform(24, 50)) for _ in range(200)])
    back = spatial.with_unprojected(spatial.with_projected(df), names=("lon2", "lat2"))
    worst = back.select(F.max(F.abs(F.col("lon2") - F.col("lon"))), F.max(F.abs(F.col("lat2") - F.col("lat")))).first()
    assert worst[0] < 1e-7 and worst[1] < 1e-7


def square(x, y, size):
    return [[x, y], [x + size, y], [x + size, y + size], [x, y + size], [x, y]]


def shape(spark, *rings):
    edges = ", ".join(geometry.ring_edges(f"array{tuple(f'array({x}D,{y}D)' for x, y in r)}".replace("'", "")) for r in rings)
    return spark.range(1).select(F.expr(f"concat({edges})").alias("edges"), F.lit(True).alias("areal"))


def at(df, x, y):
    return df.select(
        F.expr(geometry.covers(f"{x}D", f"{y}D", "edges", "areal")).alias("covers"),
        F.expr(geometry.distance(f"{x}D", f"{y}D", "edges", "areal")).alias("distance"),
    ).first()


def test_polygon_with_hole(spark):
    ring = shape(spark, square(0, 0, 10), square(4, 4, 2))
    assert at(ring, 1.0, 1.0) == (True, 0.0)
    assert at(ring, 5.0, 5.0) == (False, 1.0)
    assert at(ring, 4.0, 5.0) == (True, 0.0)  # on the rim of the hole
    assert at(ring, 13.0, 14.0) == (False, 5.0)


def test_multipolygon(spark):
    two = shape(spark, square(0, 0, 1), square(10, 0, 1))
    assert at(two, 0.5, 0.5)[0] and at(two, 10.5, 0.5)[0]
    assert at(two, 4.0, 0.5) == (False, 3.0)


def test_boundary_counts_as_inside(spark):
    one = shape(spark, square(0, 0, 4))
    for x, y in [(0.0, 0.0), (4.0, 4.0), (4.0, 2.0), (2.0, 4.0), (0.0, 1.0), (2.0, 0.0)]:
        assert at(one, x, y) == (True, 0.0), (x, y)
    assert not at(one, 4.000001, 2.0)[0]


def test_unclosed_ring_is_closed(spark):
    one = shape(spark, square(0, 0, 4)[:-1])
    assert at(one, 1.0, 2.0) == (True, 0.0)
    assert at(one, -3.0, 2.0) == (False, 3.0)


def test_envelope(spark):
    bounds = shape(spark, square(1, 2, 3)).select(
        *[F.expr(text).alias(name) for name, text in geometry.envelope("edges").items()]
    ).first()
    assert bounds.asDict() == {"minx": 1.0, "miny": 2.0, "maxx": 4.0, "maxy": 5.0}


def test_great_circle(spark):
    quarter = spark.range(1).select(F.expr(sphere.great_circle_m("0D", "0D", "90D", "0D"))).first()[0]
    assert quarter == pytest.approx(sphere.EARTH_RADIUS_M * 3.141592653589793 / 2)
