"""What a tile knows of a feature: its own edges and the parity of a corner."""

import math
import random

import pytest
from pyspark.sql import functions as F

from placetally.operators import spatial
from tests.test_geo import square
from tests.test_spatial import layer, polygons, ring_distance


def places_of(spark, points):
    rows = [(float(i), 0.0, float(x), float(y)) for i, (x, y) in enumerate(points)]
    return spark.createDataFrame(rows, "cell_lon double, cell_lat double, x double, y double")


def circle(radius, corners, x=0.0, y=0.0):
    ring = [[x + radius * math.cos(2 * math.pi * k / corners), y + radius * math.sin(2 * math.pi * k / corners)] for k in range(corners)]
    return ring + ring[:1]


def test_outlines_and_places_on_the_lines_of_the_grid(spark):
    # corners and edges on tile borders, holes, several parts, edges along which places lie
    step = 1000.0
    plus = [[0, 1], [1, 1], [1, 0], [2, 0], [2, 1], [3, 1], [3, 2], [2, 2], [2, 3], [1, 3], [1, 2], [0, 2], [0, 1]]
    shapes = {
        "plus": [[[x * step, y * step] for x, y in plus]],
        "holed": [square(5 * step, 0, 4 * step), square(6 * step, step, 2 * step)],
        "parts": [square(0, 5 * step, step), square(2 * step, 5 * step, 2 * step)],
        "backwards": [square(5 * step, 5 * step, 3 * step)[::-1]],
    }
    features = layer(spark, *[
        (name, "MultiPolygon" if name == "parts" else "Polygon", [[r] for r in rings] if name == "parts" else rings)
        for name, rings in shapes.items()
    ])
    points = [(x * step / 2, y * step / 2) for x in range(-1, 20) for y in range(-1, 18)]
    points += [(x + 0.25, y - 0.125) for x, y in points]

    def on_outline(x, y, rings):
        return any(min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2)
                   for ring in rings for (x1, y1), (x2, y2) in zip(ring, ring[1:]))  # all edges run along an axis

    def within(x, y, rings):
        crossed = sum((y1 > y) != (y2 > y) and x < x1 for ring in rings for (x1, y1), (x2, y2) in zip(ring, ring[1:]))
        return crossed % 2 == 1 or on_outline(x, y, rings)

    want = {float(i): next((n for n, rings in shapes.items() if within(x, y, rings)), None) for i, (x, y) in enumerate(points)}
    for tile in (step, 700.0, 50_000.0):
        got = spatial.nearest_feature(places_of(spark, points), features, {"name": "NAME"}, 0, tile)
        assert {r.cell_lon: r.name for r in got.collect()} == want


@pytest.mark.parametrize("reach", [0, 3_000])
def test_detailed_outlines_on_fine_tiles(spark, reach):
    rng = random.Random(8)
    rings = {}
    for i in range(6):
        cx, cy, n = rng.uniform(-2e4, 2e4), rng.uniform(-2e4, 2e4), 400
        radii = [1.5e4 * (0.6 + 0.3 * math.sin(7 * k / n * 6.283) + 0.1 * rng.random()) for k in range(n)]
        ring = [[cx + r * math.cos(2 * math.pi * k / n), cy + r * math.sin(2 * math.pi * k / n)] for k, r in enumerate(radii)]
        rings[f"s{i}"] = ring + ring[:1]
    points = [(rng.uniform(-5e4, 5e4), rng.uniform(-5e4, 5e4)) for _ in range(300)]
    got = spatial.nearest_feature(places_of(spark, points), polygons(spark, **rings), {"name": "NAME"}, reach, 4_000)
    want = {}
    for i, (x, y) in enumerate(points):
        distance, _, name = min((ring_distance(x, y, ring), k, n) for k, (n, ring) in enumerate(rings.items()))
        want[float(i)] = name if distance <= reach else None
    assert {r.cell_lon: r.name for r in got.collect()} == want and len(set(want.values())) == 7


def test_stored_edges_grow_with_the_outline(spark):
    features = polygons(spark, disc=circle(100_000, 2_000))
    stored, tiles, covered = {}, {}, {}
    for tile in (20_000, 10_000, 5_000):
        found = spatial.feature_tiles(features, {"name": "NAME"}, tile, 0)
        row = found.agg(
            F.sum(F.size("edges")).alias("edges"), F.count("*").alias("tiles"), F.sum(F.expr("int(size(edges) = 0)")).alias("covered")
        ).first()
        stored[tile], tiles[tile], covered[tile] = row.edges, row.tiles, row.covered
    # an edge is stored once, and once more for each border of tiles that it crosses
    assert all(2_000 <= n <= 2_000 + 4 * 2 * 200_000 / tile + 100 for tile, n in stored.items())
    # tiles inside are rows without edges, and nothing is stored outside
    assert covered[5_000] > 0.8 * tiles[5_000] and tiles[5_000] < 1.15 * math.pi * 20 ** 2 + 200


def test_pairs_that_are_measured_stay_few(spark):
    rng = random.Random(4)
    rings = {f"s{i}": circle(2_000, 60, rng.uniform(-1e5, 1e5), rng.uniform(-1e5, 1e5)) for i in range(400)}
    features, reach, tile = polygons(spark, **rings), 80_000, 100_000
    places = places_of(spark, [(rng.uniform(-9e4, 9e4), rng.uniform(-9e4, 9e4)) for _ in range(200)])
    placed = places.withColumns({"tx": F.expr(f"floor(x / {tile}D)"), "ty": F.expr(f"floor(y / {tile}D)")})
    tiles = spatial.feature_tiles(features, {"name": "NAME"}, tile, reach)
    for bounded in (True, False):
        pairs = spatial.measured_pairs(placed, tiles, reach, spatial.CELL_KEYS, bounded, 1_000_000).filter("edges is not null").count()
        # on average 90 outlines lie within reach of a place
        assert 200 <= pairs <= 200 * 6
    got = spatial.nearest_feature(places, features, {"name": "NAME"}, reach, tile)
    for r in got.join(places, ["cell_lon", "cell_lat"]).collect():
        assert r.name == min((ring_distance(r.x, r.y, ring), k, n) for k, (n, ring) in enumerate(rings.items()))[2]
