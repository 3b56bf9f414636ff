import json
import math
import random

import pytest
from pyspark.sql import functions as F

from placetally.operators import results, skew, spatial
from placetally.operators.skew import heavy_keys, split_join
from placetally.sources.boundaries import as_features, read_features
from tests.conftest import plan, rows
from tests.test_geo import KNOWN, points, square

# Fixed values of the fixture: outlines in metres of the projection.
POLYGON_1 = [[-2078950.174314544, 1019320.543241758], [-2070179.999376244, 1048168.999269501],
             [-2024609.876997347, 1034481.530479143], [-2033186.997251831, 1005575.088432894],
             [-2078950.174314544, 1019320.543241758]]
POLYGON_2 = [[-2063286.342757291, 1070110.375731140], [-2057299.938358678, 1089804.077966402],
             [-2013029.520214192, 1076504.808934758], [-2018887.104978406, 1056772.408014320],
             [-2063286.342757291, 1070110.375731140]]
WITHIN, AT_3200, AT_53000 = (k[:2] for k in KNOWN)


def layer(spark, *shapes):
    """Features from (name, type, coordinates)."""
    raw = [(i, str(i), {"NAME": n, "STATE": n, "COUNTY": n, "NAME10": n}, t, json.dumps(c)) for i, (n, t, c) in enumerate(shapes)]
    return as_features(
        spark.createDataFrame(raw, "fid bigint, id string, properties map<string,string>, geometry_type string, coordinates string")
    )


def polygons(spark, **rings):
    return layer(spark, *[(name, "Polygon", [ring]) for name, ring in rings.items()])


def found(df, *columns):
    return {r.id: tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in df.collect()}


def test_containment(spark):
    df = points(spark, [WITHIN, AT_3200, AT_53000])
    one = polygons(spark, polygon1=POLYGON_1)
    joined = spatial.join_containing(df, one, {"name": "NAME"}, snap="exact")
    assert found(joined, "name") == {0: "polygon1"}
    joined = spatial.join_containing(df, one, {"name": "NAME"}, snap="exact", how="left")
    assert found(joined, "name") == {0: "polygon1", 1: None, 2: None}


@pytest.mark.parametrize("reach, hit", [(3000, False), (4000, True)])
def test_buffer(spark, reach, hit):
    df = points(spark, [AT_3200])
    joined = spatial.join_nearest(df, polygons(spark, polygon1=POLYGON_1), {"name": "NAME"}, reach, snap="exact")
    assert found(joined, "name") == ({0: "polygon1"} if hit else {})


def test_nearest_of_two(spark):
    both = polygons(spark, polygon2=POLYGON_2, polygon1=POLYGON_1)
    joined = spatial.join_nearest(points(spark, [WITHIN, AT_3200, AT_53000]), both, {"name": "NAME"}, 100_000, snap="exact")
    assert found(joined, "name") == {0: "polygon1", 1: "polygon1", 2: "polygon2"}


def test_known_distances(spark):
    both = polygons(spark, polygon1=POLYGON_1, polygon2=POLYGON_2)
    expected = {WITHIN: (0.0, 38628.376), AT_3200: (3159.438, 19836.493), AT_53000: (55605.197, 12025.903)}
    for place, distances in expected.items():
        got = {r.fid: r.distance_m for r in results.near_features(both, *place).collect()}
        assert (got[0], got[1]) == pytest.approx(distances, abs=1e-3)
    assert [r.fid for r in results.near_features(both, *AT_53000, max_m=20_000).collect()] == [1]
    assert [r.fid for r in results.intersecting(both, *WITHIN).collect()] == [0]


def test_equally_near_takes_the_lowest_fid(spark):
    x, y = KNOWN[0][2:]
    twins = polygons(spark, b=square(x - 500, y - 500, 1000), a=square(x - 400, y - 400, 800))
    for how in (spatial.join_containing, spatial.join_nearest):
        assert found(how(points(spark, [WITHIN]), twins, {"name": "NAME"}), "name") == {0: "b"}


def test_points_that_cannot_be_looked_up(spark):
    df = spark.createDataFrame([(1, None, 45.0), (2, *WITHIN)], "id int, lon double, lat double")
    one = polygons(spark, polygon1=POLYGON_1)
    assert found(spatial.join_containing(df, one, {"name": "NAME"}), "name") == {2: "polygon1"}
    assert found(spatial.join_containing(df, one, {"name": "NAME"}, how="left"), "name") == {1: None, 2: "polygon1"}


def test_broken_and_empty_geometries_match_nothing(spark):
    shapes = layer(
        spark, ("good", "Polygon", [POLYGON_1]), ("null corner", "Polygon", [[[None, 1.0], *POLYGON_1]]),
        ("not a ring", "Polygon", "oops"), ("no type", None, [POLYGON_1]), ("empty", "Polygon", []),
    )
    assert found(spatial.join_containing(points(spark, [WITHIN]), shapes, {"name": "NAME"}), "name") == {0: "good"}
    assert [r.fid for r in results.near_features(shapes, *WITHIN).collect()] == [0]


def test_geometry_types(spark):
    shapes = layer(
        spark, ("multi", "MultiPolygon", [[square(0, 0, 10)], [square(100, 0, 10), square(104, 4, 2)]]),
        ("line", "LineString", [[0, 50], [100, 50]]), ("lines", "MultiLineString", [[[0, 80], [10, 80]], [[0, 90], [10, 90]]]),
        ("point", "Point", [500, 500]), ("points", "MultiPoint", [[600, 0], [700, 0]]),
    )
    got = {r.fid: (r.areal, r.n, r.minx, r.miny, r.maxx, r.maxy) for r in shapes.withColumn("n", F.size("edges")).collect()}
    assert got == {
        0: (True, 12, 0.0, 0.0, 110.0, 10.0), 1: (False, 1, 0.0, 50.0, 100.0, 50.0), 2: (False, 2, 0.0, 80.0, 10.0, 90.0),
        3: (False, 1, 500.0, 500.0, 500.0, 500.0), 4: (False, 2, 600.0, 0.0, 700.0, 0.0),
    }


def star(rng, cx, cy, radius, corners):
    ring = [[cx + radius * r * math.cos(a), cy + radius * r * math.sin(a)]
            for a, r in ((2 * math.pi * k / corners, rng.uniform(0.3, 1)) for k in range(corners))]
    return ring + ring[:1]


def ring_distance(x, y, ring):
    """0 inside, else the distance to the outline."""
    inside, best = False, math.inf
    for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            inside = not inside
        dx, dy = x2 - x1, y2 - y1
        t = max(0.0, min(1.0, ((x - x1) * dx + (y - y1) * dy) / (dx * dx + dy * dy)))
        best = min(best, math.hypot(x - x1 - t * dx, y - y1 - t * dy))
    return 0.0 if inside else best


@pytest.mark.parametrize("bounded", [True, False])
@pytest.mark.parametrize("reach", [0, 30_000])
def test_nearest_against_all_pairs(spark, reach, bounded):
    rng = random.Random(5)
    rings = {f"s{i}": star(rng, rng.uniform(-3e5, 3e5), rng.uniform(-3e5, 3e5), rng.uniform(2e4, 2e5), 40) for i in range(25)}
    places = [(float(i), 0.0, rng.uniform(-5e5, 5e5), rng.uniform(-5e5, 5e5)) for i in range(400)]
    df = spark.createDataFrame(places, "cell_lon double, cell_lat double, x double, y double")
    got = spatial.nearest_feature(
        df, polygons(spark, **rings), {"name": "NAME"}, reach, 50_000, bounded=bounded, rows_per_task=2
    )
    expected = {}
    for key, _, x, y in places:
        distance, _, name = min((ring_distance(x, y, ring), i, n) for i, (n, ring) in enumerate(rings.items()))
        if distance <= reach:
            expected[key] = name
    assert {r.cell_lon: r.name for r in got.collect()} == {key: expected.get(key) for key, *_ in places}
    assert len(expected) > 50


def test_lookup_by_shuffle_equals_broadcast(spark):
    rng = random.Random(3)
    df = points(spark, [(rng.uniform(-123.2, -122), rng.uniform(45, 46.5)) for _ in range(300)] + [WITHIN] * 200)
    both = polygons(spark, polygon1=POLYGON_1, polygon2=POLYGON_2)
    small = spatial.join_nearest(df, both, {"name": "NAME"}, 20_000)
    large = spatial.join_nearest(df, both, {"name": "NAME"}, 20_000, broadcast_bytes=0)
    assert rows(small) == rows(large) and small.count() > 200


def test_within_against_all_pairs(spark):
    rng = random.Random(4)
    spots = [(i, rng.uniform(-1000, 1000), rng.uniform(-1000, 1000), rng.choice("ab")) for i in range(300)]
    others = [(i, rng.uniform(-1000, 1000), rng.uniform(-1000, 1000), rng.choice("ab")) for i in range(300)]
    others += [(1000 + i, 0.0, 0.0, "a") for i in range(200)]  # a crowded tile
    pairs = spatial.join_within(
        spark.createDataFrame(spots, "spot int, x double, y double, kind string"),
        spark.createDataFrame(others, "other int, other_x double, other_y double, kind string"),
        100, on=["kind"], spread_by=["other"], rows_per_task=10,
    )
    expected = [(s, o) for s, x, y, k in spots for o, ox, oy, ok in others if k == ok and math.hypot(x - ox, y - oy) <= 100]
    assert rows(pairs.select("spot", "other")) == sorted(expected, key=repr)


def test_plans_compare_no_pairs_across_tiles(spark):
    df = points(spark, [WITHIN, AT_3200])
    both = polygons(spark, polygon1=POLYGON_1, polygon2=POLYGON_2)
    cells = spatial.with_projected(spatial.with_snapped(df), "cell_lon", "cell_lat")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for bounded in (True, False):
            text = plan(spatial.nearest_feature(cells, both, {"name": "NAME"}, 80_450, 100_000, bounded=bounded))
            assert "SortMergeJoin" in text
            assert "Cartesian" not in text and "NestedLoop" not in text and "Python" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_records_are_not_projected_ahead_of_the_distinct_step(spark, tmp_path):
    points(spark, [WITHIN, AT_3200]).write.parquet(str(tmp_path / "p"))
    df = spatial.with_snapped(spark.read.parquet(str(tmp_path / "p")))
    cells = spatial.with_projected(df.select("cell_lon", "cell_lat").distinct(), "cell_lon", "cell_lat")
    located = spatial.nearest_feature(cells, polygons(spark, polygon1=POLYGON_1), {"name": "NAME"}, 0, 50_000)
    lines = located._jdf.queryExecution().optimizedPlan().toString().split("\n")
    scan = next(i for i, line in enumerate(lines) if "parquet" in line)
    distinct = max(i for i, line in enumerate(lines[:scan]) if "Aggregate [" in line)
    assert "SIN(" in lines[distinct] and not any("SIN(" in line for line in lines[distinct + 1:scan])


def test_cell_reuse(spark):
    df = points(spark, [WITHIN, WITHIN, AT_3200])
    assert rows(spatial.cell_reuse_stats(df)) == [(1, 2)]
    assert rows(spatial.cell_reuse_stats(df.limit(0))) == [(0, 0)]


def test_crowded_points_are_split_from_lookup_counts(spark):
    df = spatial.with_snapped(points(spark, [WITHIN] * 50 + [(-80.0, 30.0)] * 60 + [AT_3200]))
    lookup = spatial.lookup_places(df, polygons(spark, polygon1=POLYGON_1), {"name": "NAME"}, 0, 50_000)
    assert sorted(r.n for r in lookup.frame.collect()) == [1, 50, 60] and lookup.found == 1
    joined = spatial.attach_places(df, lookup, broadcast_bytes=0, spread_by=["id"], rows_per_task=10)
    assert rows(joined) == rows(spatial.attach_places(df, lookup)) and joined.count() == 50
    left = spatial.attach_places(df, lookup, "left", broadcast_bytes=0, spread_by=["id"], rows_per_task=10)
    assert rows(left) == rows(spatial.attach_places(df, lookup, "left")) and left.count() == 111


def test_split_join_spreads_a_hot_key(spark):
    large = spark.range(10_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), "id",
    )
    small = large.select("k").distinct().withColumn("v", F.length("k"))
    assert rows(heavy_keys(large, ["k"], 100)) == [("hot", 34)]
    for how in ("inner", "left"):
        joined = split_join(large, small.filter("k <> '1'"), ["k"], ["id"], how, rows_per_task=100)
        assert rows(joined) == rows(large.join(small.filter("k <> '1'"), "k", how))
        assert joined.columns == ["k", "id", "v"]


def test_read_features(spark, tmp_path):
    features = [
        {"type": "Feature", "id": "f", "properties": {"NAME": "Doña Ana", "ALAND": 12.5, "X": None},
         "geometry": {"type": "Polygon", "coordinates": [POLYGON_1]}},
        {"type": "Feature", "properties": {"NAME": "none"}, "geometry": None},
        {"type": "Feature", "properties": {"NAME": "two"},
         "geometry": {"type": "MultiPolygon", "coordinates": [[square(0, 0, 1)], [square(5, 5, 1)]]}},
    ]
    text = json.dumps({"type": "FeatureCollection", "features": features}, ensure_ascii=False, indent=1)
    path = tmp_path / "layer.geojson"
    path.write_bytes(text.encode("latin-1"))
    got = {r.fid: r for r in read_features(spark, str(path)).collect()}
    assert got[0].id == "f" and got[0].properties["NAME"] == "Doña Ana" and got[0].properties["ALAND"] == "12.5"
    assert len(got[0].edges) == 4 and got[0].minx == POLYGON_1[0][0] and got[0].maxy == POLYGON_1[1][1]
    assert got[1].edges is None and got[1].minx is None
    assert len(got[2].edges) == 8 and got[2].maxx == 6.0
    path.write_bytes(text.encode("utf-8"))
    assert read_features(spark, str(path), "UTF-8").filter("fid = 0").first().properties["NAME"] == "Doña Ana"


def test_every_key_over_the_threshold_is_split(spark):
    large = spark.range(60_000).selectExpr("id % 20000 as k", "id").union(spark.range(500).selectExpr("7L", "id"))
    small = spark.range(20_000).selectExpr("id as k", "id * 10 as v")
    hot = heavy_keys(large, ["k"], 2)
    assert hot.count() == 20_000 and hot.filter("k = 7").first()[1] == 252
    assert split_join(large, small, ["k"], ["id"], rows_per_task=2).count() == large.join(small, "k").count() == 60_500
    # beyond a share of all rows only: the list is limited by that, whatever the input
    assert skew.LEAST_SHARE * 1_000_000 <= 1
    few = spark.range(10).selectExpr("id as k", "3000000 as count")
    assert skew.heaviest(few, ["k"], 10).count() == 10


def test_grid_decides_whether_tiles_are_split():
    assert spatial.places_per_tile(7, "rounded", 100_000) < 100_000
    assert spatial.places_per_tile(8, "center", 100_000) > 10_000_000
    assert spatial.places_per_tile(8, "exact", 1) == float("inf")


def test_hot_key_lands_in_many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        large = spark.range(9_000).selectExpr("if(id % 3 = 0, -1, id) as k", "id")
        small = large.selectExpr("k", "k as v").distinct()
        for joined, busiest in ((large.join(small, "k"), 3000), (split_join(large, small, ["k"], ["id"], rows_per_task=100), 1500)):
            by_partition = joined.groupBy(F.spark_partition_id().alias("p")).count()
            sizes = [r["count"] for r in by_partition.collect()]
            assert sum(sizes) == 9_000
            assert (max(sizes) >= 3000) == (busiest == 3000)
            assert max(sizes) <= busiest + 600
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", before)
