import math
import random

import pytest
from pyspark.sql import functions as F

from placetally.functions import geometry
from placetally.operators import quadtree, spatial
from placetally.operators.quadtree import LEVEL, LEVELS, NODE, PARTS, Quadtree, with_fine
from tests.conftest import plan, rows
from tests.test_geo import square
from tests.test_spatial import layer

RADIUS = 100.0


def spots_of(spark, data):
    return spark.createDataFrame(data, "spot int, x double, y double, kind string")


def others_of(spark, data):
    return spark.createDataFrame(data, "other int, other_x double, other_y double, kind string")


def city_and_country(rng, spots=3000, others=600, crowd=4000):
    """Spots over 20 by 20 km, and others of which most are in one city of 500 m."""
    around = [(i, rng.uniform(-10_000, 10_000), rng.uniform(-10_000, 10_000), "a") for i in range(spots)]
    around += [(spots + i, rng.uniform(-400, 400), rng.uniform(-400, 400), "a") for i in range(60)]
    far = [(i, rng.uniform(-10_000, 10_000), rng.uniform(-10_000, 10_000), "a") for i in range(others)]
    return around, far + [(others + i, rng.uniform(-250, 250), rng.uniform(-250, 250), "a") for i in range(crowd)]


def all_pairs(spots, others, radius=RADIUS):
    return sorted(
        ((s, o) for s, x, y, k in spots for o, ox, oy, ok in others
         if k == ok and None not in (k, x, y, ox, oy) and math.hypot(x - ox, y - oy) <= radius),
        key=repr,
    )


@pytest.mark.parametrize("rows_per_task", [1, 40, 3_000, 10**9])
def test_same_pairs_however_often_tiles_are_cut(spark, rows_per_task):
    rng = random.Random(1)
    spots = [(i, rng.uniform(-900, 900), rng.uniform(-900, 900), rng.choice("ab")) for i in range(120)]
    spots += [(200 + i, float(x), float(y), "a") for i, (x, y) in enumerate([(0, 0), (-100, 0), (100, 100), (25, -25), (1600, -1600)])]
    spots += [(300, None, 5.0, "a"), (301, 5.0, 5.0, None)]
    others = [(i, rng.uniform(-900, 900), rng.uniform(-900, 900), rng.choice("ab")) for i in range(120)]
    others += [(200 + i, 0.0, 0.0, "a") for i in range(150)]  # many at one place: the last level is split by hash
    others += [(400, 100.0, 0.0, "a"), (401, 1600.0, -1700.0, "a"), (402, 0.0, None, "a"), (403, 5.0, 5.0, None)]
    found = spatial.join_within(
        spots_of(spark, spots), others_of(spark, others), RADIUS, on=["kind"], spread_by=["other"], rows_per_task=rows_per_task,
        spots_per_tile=9,
    )
    assert rows(found.select("spot", "other")) == all_pairs(spots, others)
    assert found.columns.count("kind") == 1 and set(found.columns) == {"kind", "spot", "x", "y", "other", "other_x", "other_y", "dist"}


def test_a_city_is_cut_by_space(spark):
    spots, others = city_and_country(random.Random(2))
    per_task, per_tile = 2_000, 4.0
    placed = with_fine(others_of(spark, others), "other_x", "other_y", RADIUS)
    tree = Quadtree.of(placed, RADIUS, ["kind"], per_task, per_tile)
    assert tree.depth > 2 and not tree.split
    copies = tree.spots(spots_of(spark, spots)).cache()
    located = tree.others(placed).cache()
    assert located.count() == len(others)  # each in one tile
    # rows that are repeated, over all spots of a land with one dense city
    assert copies.count() <= 2 * len(spots)
    # what a task measures: nothing but the pairs of one tile
    pairs = copies.join(located, ["kind", *NODE]).groupBy("kind", *NODE).count()
    assert pairs.agg(F.max("count")).first()[0] <= 2 * per_task
    assert pairs.agg(F.sum("count")).first()[0] < len(spots) * len(others) / 20
    # cutting the city's tile by a hash into parts as small repeats more
    city = Quadtree(RADIUS, ("kind",), tree.nodes, 0, False)
    whole = city.spots(spots_of(spark, spots)).join(city.others(placed), ["kind", *NODE]).groupBy(*NODE).count()
    parts = whole.agg(F.max("count")).first()[0] / per_task
    near_city = city.spots(spots_of(spark, spots)).join(city.others(placed).select("kind", *NODE).distinct(), ["kind", *NODE])
    assert copies.filter(f"{LEVEL} > 0").count() < parts * near_city.filter("abs(x) < 500 and abs(y) < 500").count()


def test_even_land_keeps_large_tiles(spark):
    spots, others = city_and_country(random.Random(3), crowd=0)
    placed = with_fine(others_of(spark, others), "other_x", "other_y", RADIUS)
    tree = Quadtree.of(placed, RADIUS, ["kind"], 1_000_000, 60)
    assert (tree.depth, tree.split, tree.nodes.count()) == (0, False, 0)
    assert tree.spots(spots_of(spark, spots)).count() < 1.4 * len(spots)
    text = plan(tree.joined(placed, spots_of(spark, spots), ["other"]))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_one_place_is_split_by_hash(spark):
    others = [(i, 7.0, 7.0, "a") for i in range(500)]
    placed = with_fine(others_of(spark, others), "other_x", "other_y", RADIUS)
    tree = Quadtree.of(placed, RADIUS, ["kind"], 50, 1.0)
    assert tree.depth == LEVELS - 1 and tree.split
    assert [r[PARTS] for r in tree.nodes.filter(f"{LEVEL} = {LEVELS - 1}").collect()] == [10]
    found = tree.joined(placed, spots_of(spark, [(1, 0.0, 0.0, "a"), (2, 60.0, 60.0, "a"), (3, 500.0, 0.0, "a")]), ["other"])
    assert found.groupBy("spot").count().filter("spot < 3").select("count").distinct().collect() == [(500,)]


def test_empty_sides(spark):
    some, none = [(1, 0.0, 0.0, "a")], []
    for spots, others in ((some, none), (none, some), (none, none)):
        assert spatial.join_within(spots_of(spark, spots), others_of(spark, others), RADIUS, on=["kind"]).count() == 0


def farthest_side(dx, dy, sides):
    """How far an offset lies along the normal of the side that it is nearest to."""
    return max(
        dx * math.cos(math.pi * (2 * k + 1) / sides) + dy * math.sin(math.pi * (2 * k + 1) / sides) for k in range(sides)
    )


@pytest.mark.parametrize("sides", [8, 64])
def test_polygon_around_a_point(spark, sides):
    rng = random.Random(4)
    inner = math.cos(math.pi / sides)
    data = []
    for i in range(4000):
        angle, share = rng.uniform(-math.pi, math.pi), rng.uniform(inner - 1e-3, 1 + 1e-3)
        data.append((i, RADIUS * share * math.cos(angle), RADIUS * share * math.sin(angle)))
    df = spark.createDataFrame(data, "id int, dx double, dy double")
    got = {r.id for r in df.filter(geometry.in_polygonal_circle("dx", "dy", RADIUS, sides)).collect()}
    assert got == {i for i, dx, dy in data if farthest_side(dx, dy, sides) <= RADIUS * inner}
    ring = {i for i, dx, dy in data if math.hypot(dx, dy) <= RADIUS}
    assert got < ring  # what lies between the polygon and the circle
    with pytest.raises(ValueError, match="multiple of 4"):
        geometry.in_polygonal_circle("dx", "dy", RADIUS, 6)


def least_over_segment(x1, y1, x2, y2, sides):
    """The least of a convex function along a segment, by thirds."""
    low, high = 0.0, 1.0
    value = lambda t: farthest_side(x1 + t * (x2 - x1), y1 + t * (y2 - y1), sides)
    for _ in range(100):
        third = (high - low) / 3
        if value(low + third) <= value(high - third):
            high -= third
        else:
            low += third
    return value((low + high) / 2)


@pytest.mark.parametrize("sides", [8, 64])
def test_polygon_and_segments(spark, sides):
    rng = random.Random(5)
    data = []
    for i in range(600):
        angle, share, turn = rng.uniform(-math.pi, math.pi), rng.uniform(0.9, 1.03), rng.uniform(1.2, 1.9)
        x, y = 100 * share * math.cos(angle), 100 * share * math.sin(angle)
        reach = rng.choice([0.0, 3.0, 80.0])
        dx, dy = reach * math.cos(angle + turn), reach * math.sin(angle + turn)
        data.append((i, 5 + x - dx, -3 + y - dy, 5 + x + dx, -3 + y + dy))
    df = spark.createDataFrame(data, "id int, x1 double, y1 double, x2 double, y2 double").withColumn(
        "edges", F.array(F.struct("x1", "y1", "x2", "y2"))
    )
    meets = geometry.meets_polygonal_circle("5D", "(-3D)", "edges", RADIUS, sides)
    got = {r.id for r in df.filter(meets).collect()}
    limit = RADIUS * math.cos(math.pi / sides)
    least = {i: least_over_segment(x1 - 5, y1 + 3, x2 - 5, y2 + 3, sides) for i, x1, y1, x2, y2 in data}
    assert all(abs(v - limit) > 1e-7 for v in least.values())
    assert got == {i for i, v in least.items() if v <= limit} and 50 < len(got) < 550


def test_nearest_of_those_that_meet_the_polygon(spark):
    """The nearest one lies between polygon and circle; a farther one, behind a corner, is met."""
    gap = RADIUS * (1 + math.cos(math.pi / 8)) / 2
    angle = math.pi / 8
    at_side = (gap * math.cos(angle), gap * math.sin(angle))
    both = layer(
        spark,
        ("side", "Point", [at_side[0], at_side[1]]),
        ("corner", "Polygon", [square(99, -5, 20)]),
    )
    place = spark.createDataFrame([(0.0, 0.0, 1.0, 1.0)], "x double, y double, cell_lon double, cell_lat double")

    def nearest(sides, bounded=True):
        found = spatial.nearest_feature(place, both, {"name": "NAME"}, RADIUS, 1_000, bounded=bounded, sides=sides)
        return found.first().name

    assert nearest(None) == "side"
    assert nearest(8) == nearest(8, bounded=False) == "corner"


def test_tiles_of_the_module_fit_together():
    assert quadtree.side_m(RADIUS, LEVELS - 1) == RADIUS / 4
