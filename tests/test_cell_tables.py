import math
import random

import pytest
from pyspark.sql import functions as F

from placetally.functions.sphere import EARTH_RADIUS_M, search_boxes
from placetally.operators import cell_tables, results
from placetally.operators.cell_tables import cover
from placetally.operators.spatial import with_cell
from tests.conftest import plan

PLACES = [(-96.4, 39.2), (179.9, -17.0), (-180.0, 10.0), (30.0, 89.5), (0.0, -90.0), (0.0, 0.0)]


def haversine(lon1, lat1, lon2, lat2):
    a = math.sin(math.radians(lat2 - lat1) / 2) ** 2
    a += math.sin(math.radians(lon2 - lon1) / 2) ** 2 * math.cos(math.radians(lat1)) * math.cos(math.radians(lat2))
    return 2 * EARTH_RADIUS_M * math.asin(min(1.0, math.sqrt(a)))


def world(spark, n=6000):
    """Points all over the globe, more around the places, some on edges of cells, some unknown."""
    rng = random.Random(7)
    data = [(i, rng.uniform(-180, 180), math.degrees(math.asin(rng.uniform(-1, 1)))) for i in range(n)]
    for lon, lat in PLACES:
        for _ in range(200):
            at = lon + rng.gauss(0, 2)
            data.append((len(data), (at + 180) % 360 - 180, max(-90.0, min(90.0, lat + rng.gauss(0, 1)))))
    data += [(len(data) + i, lon, lat) for i, (lon, lat) in enumerate([(-180.0, 10.0), (180.0, 10.0), (0.0, 0.0), (0.0, 0.0)])]
    data += [(len(data), None, 5.0), (len(data) + 1, 5.0, None)]
    return data, spark.createDataFrame(data, "id int, lon double, lat double")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    data, df = world(spark)
    path = str(tmp_path_factory.mktemp("cells") / "points")
    cell_tables.write_by_cell(df.withColumn("tags", F.create_map(F.lit("a"), F.lit("b"))), path)
    return data, df, path


@pytest.mark.parametrize("lon, lat", PLACES)
def test_cover_holds_the_circle(spark, stored, lon, lat):
    data, df, path = stored
    table = spark.read.parquet(path)
    assert table.count() == len(data)  # those without a coordinate are kept
    for reach in (1.0, 30_000.0, 400_000.0, 9_000_000.0, 30_000_000.0):
        expected = sorted(i for i, x, y in data if x is not None and y is not None and haversine(lon, lat, x, y) <= reach)
        assert sorted(r.id for r in cell_tables.within(table, lon, lat, reach).select("id").collect()) == expected
        assert sorted(r.id for r in results.near(df, lon, lat, reach).select("id").collect()) == expected
        assert len(cover(lon, lat, reach)) <= cell_tables.COVER_CELLS


def test_order_of_ids_is_that_of_the_cover(spark):
    _, df = world(spark, 500)
    cells = [r.cell for r in with_cell(df, precision=8).filter("cell is not null").collect()]
    whole = cover(0, 0, 3e7)
    assert whole == [("00000000", "zzzzzzzz")]
    for lon, lat in PLACES:
        inside = [[any(low <= c <= high for low, high in cover(lon, lat, 50_000, cells=n)) for c in cells] for n in (2, 200)]
        assert all(a or not b for a, b in zip(*inside))  # a finer cover is part of a coarser one


@pytest.mark.parametrize("lon, lat, k", [(*PLACES[0], 150), (*PLACES[1], 7), (*PLACES[3], 150), (*PLACES[4], 1), (0.0, 0.0, 100_000)])
def test_nearest(spark, stored, lon, lat, k):
    data, _, path = stored
    found = cell_tables.nearest(spark.read.parquet(path), lon, lat, k, order=["id"])
    known = sorted((haversine(lon, lat, x, y), i) for i, x, y in data if x is not None and y is not None)
    got = [(r.distance_m, r.id) for r in found.select("distance_m", "id").collect()]
    assert len(got) == min(k, len(known))
    assert [d for d, _ in got] == pytest.approx([d for d, _ in known[:k]], abs=1e-3)
    assert [d for d, _ in got] == sorted(d for d, _ in got)


def test_wrong_numbers_and_empty_tables(spark, tmp_path):
    empty = spark.createDataFrame([], "id int, lon double, lat double")
    cell_tables.write_by_cell(empty, str(tmp_path / "none"))
    table = spark.read.schema("id int, lon double, lat double, cell string").parquet(str(tmp_path / "none"))
    assert cell_tables.nearest(table, 0, 0, 3).count() == 0 and cell_tables.near(table, 0, 0, 1e5).count() == 0
    with pytest.raises(ValueError, match="k must be"):
        cell_tables.nearest(table, 0, 0, 0)


def test_ranges_reach_the_scan_and_skip_files(spark, tmp_path):
    """A small circle reads the rows of few row groups."""
    path = str(tmp_path / "points")
    points = spark.range(200_000).selectExpr(
        "id", "-125 + (id * 7919 % 58000) / 1000D as lon", "25 + (id * 104729 % 24500) / 1000D as lat"
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        cell_tables.write_by_cell(points, path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    found = cell_tables.within(spark.read.parquet(path), -96.4, 39.2, 20_000)
    text = plan(found)
    assert "GreaterThanOrEqual(cell," in text[text.index("PushedFilters"):] and "Exchange" not in text
    # counted on the executed plan: the rows that row groups could not rule out
    executed = found.select("id")._jdf.queryExecution()
    rows = executed.executedPlan().executeCollect()
    leaf = executed.executedPlan().collectLeaves().apply(0)
    assert len(rows) > 0 and leaf.metrics().apply("numOutputRows").value() < 20_000
    assert len([1 for r in points.collect() if haversine(-96.4, 39.2, r.lon, r.lat) <= 20_000]) == len(rows)


def test_boxes():
    assert search_boxes(0, 89, 200_000) == [(-180.0, pytest.approx(87.2, abs=0.01), 180.0, 90.0)]
    (west, _, east, _), (west2, _, east2, _) = search_boxes(179.5, 0, 100_000)
    assert west == -180.0 and east == pytest.approx(-179.6, abs=0.01)
    assert west2 == pytest.approx(178.6, abs=0.01) and east2 == 180.0
    assert search_boxes(181, 0, 1000)[0] == pytest.approx(search_boxes(-179, 0, 1000)[0])
