import os
import random

import pytest
from pyspark.sql import functions as F

from placetally.operators import spatial
from placetally.operators.known_places import layer_version
from placetally.plans import jobs, running
from placetally.schemas import POST_SCHEMA
from placetally.session import materialized, scratch_scope
from placetally.sources.running_counts import add_counts, running_counts
from tests.conftest import rows
from tests.test_jobs import posts
from tests.test_spatial import POLYGON_1, POLYGON_2, WITHIN, polygons

KEYS = "word string"


def counted(spark, *pairs):
    return spark.createDataFrame(list(pairs), "word string, n bigint")


def test_batches_add_up(spark, tmp_path):
    path = str(tmp_path / "counts")
    assert rows(running_counts(spark, path, KEYS)) == []
    for number, pairs in enumerate([[("a", 1), (None, 1)], [("a", 2), ("b", 1), ("b", 1)], [], [(None, 4), ("c", 1)]]):
        add_counts(counted(spark, *pairs), path, number, ["word"], fold_every=3)
        add_counts(counted(spark, ("wrong", 99)), path, number, ["word"], fold_every=3)  # a repeated batch counts once
    assert rows(running_counts(spark, path, KEYS)) == sorted([("a", 3), ("b", 2), ("c", 1), (None, 5)], key=repr)
    assert sorted(d for d in os.listdir(path) if d.startswith("sums")) == ["sums-2"]


def test_batch_that_failed_before_it_was_noted_is_done_again(spark, tmp_path):
    path = str(tmp_path / "counts")
    add_counts(counted(spark, ("a", 1)), path, 0, ["word"])
    counted(spark, ("a", 50)).withColumnRenamed("n", "count").write.parquet(f"{path}/batch-1")
    assert rows(running_counts(spark, path, KEYS)) == [("a", 1)]
    add_counts(counted(spark, ("a", 2)), path, 1, ["word"])
    assert rows(running_counts(spark, path, KEYS)) == [("a", 3)]


def places(spark, points):
    return spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "id int, cell_lon double, cell_lat double")


def looked_up(df, layer, known, reach=spatial.METRO_DISTANCE_M):
    return spatial.lookup_places(df, layer, spatial.METRO_PROPS, reach, spatial.METRO_TILE_M, known=known)


def test_only_unseen_points_are_measured(spark, tmp_path):
    known, layer = str(tmp_path / "known"), polygons(spark, m1=POLYGON_1, m2=POLYGON_2)
    rng = random.Random(2)
    points = [(rng.uniform(-124, -121), rng.uniform(44, 47)) for _ in range(60)] + [(-80.0, 30.0), (None, 45.0), (None, None)]
    first = looked_up(places(spark, points[:40] * 3 + points[60:]), layer, known)
    assert (first.misses, first.hits) == (41, 3 * 40 + 3 - 41)
    second = looked_up(places(spark, points), layer, known)
    assert (second.misses, second.hits) == (20, 43)
    third = looked_up(places(spark, points), layer, known)
    assert (third.misses, third.hits) == (0, 63) and third.found == second.found > 0
    plain = looked_up(places(spark, points), layer, None)
    assert rows(third.frame) == rows(second.frame) == rows(plain.frame)
    assert (third.found, third.bytes) == (plain.found, plain.bytes)
    # another layer, or another reach, has answers of its own
    assert looked_up(places(spark, points), polygons(spark, m1=POLYGON_1), known).misses == 61
    assert looked_up(places(spark, points), layer, known, reach=10_000).misses == 61


def test_points_stored_twice_count_once(spark, tmp_path):
    known, layer = str(tmp_path / "known"), polygons(spark, m1=POLYGON_1)
    looked_up(places(spark, [WITHIN]), layer, known)
    folder = f"{known}/{os.listdir(known)[0]}"
    spark.read.parquet(folder).write.mode("append").parquet(folder)
    again = looked_up(places(spark, [WITHIN, WITHIN]), layer, known)
    assert (again.misses, again.hits, again.found) == (0, 2, 1)


def test_no_points_at_all(spark, tmp_path):
    layer = polygons(spark, m1=POLYGON_1)
    for known in (None, str(tmp_path / "known")):
        for empty in (places(spark, []), places(spark, [WITHIN]).filter("1 = 0")):
            got = looked_up(empty, layer, known)
            assert (got.found, got.bytes, got.hits, got.misses, got.frame.count()) == (0, 0, 0, 0, 0)


def test_layer_version_is_of_rows_in_any_order(spark):
    both, props = polygons(spark, m1=POLYGON_1, m2=POLYGON_2), spatial.METRO_PROPS
    one = layer_version(both, props, 1)
    assert one == layer_version(both.orderBy("fid", ascending=False), props, 1)
    assert len({one, layer_version(both, props, 2), layer_version(both, {"name": "NAME10"}, 1), layer_version(both.limit(1), props, 1)}) == 4


def test_observed_hits_are_the_reuse_of_cells(spark):
    rng = random.Random(4)
    df = spark.createDataFrame([(rng.uniform(-122.51, -122.49), rng.uniform(45.49, 45.51)) for _ in range(500)], "lon double, lat double")
    stats = spatial.cell_reuse_stats(df).first()
    lookup = looked_up(spatial.with_snapped(df, snap="center"), polygons(spark, m1=POLYGON_1), None)
    assert (lookup.hits, lookup.misses) == (stats.hits, stats.misses) and stats.hits > 0 < stats.misses


def test_scope_deletes_what_it_stored(spark, tmp_path):
    with scratch_scope(spark):
        df = materialized(spark.range(3))
        assert df.count() == 3
        path = df.inputFiles()[0].removeprefix("file://")
    assert not os.path.exists(os.path.dirname(path))


@pytest.mark.parametrize("broadcast_bytes", [spatial.BROADCAST_BYTES, 0])
def test_stream_of_posts_gives_the_counts_of_one_run(spark, tmp_path, broadcast_bytes):
    rng = random.Random(7)
    words = ["alpha", "Beta!", "#gamma", "the", "(delta)"]
    items = [(" ".join(rng.choices(words, k=3)), rng.choice([None, "me", "a job"]), None, [rng.uniform(-123.2, -122), rng.uniform(45.2, 46.2)])
             for _ in range(60)]
    items += [("once rare", None, None, list(WITHIN)), (None, None, None, None), ("", None, None, list(WITHIN))]
    # a word that reaches the least count only with the second batch
    items += [("once", None, None, list(WITHIN))]
    whole, metros = posts(spark, items), polygons(spark, m1=POLYGON_1, m2=POLYGON_2)
    source, path, offsets, counties = (str(tmp_path / n) for n in ("in", "out", "offsets", "counties"))
    for low, high in ((0, 50), (50, 63), (63, 99)):
        whole.filter(f"user_id >= {low} and user_id < {high}").coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(POST_SCHEMA).parquet(source)
        running.add_metro_words(stream, metros, path, offsets, ["the"], broadcast_bytes=broadcast_bytes, fold_every=2).awaitTermination()
    expected = rows(jobs.metro_words(whole, metros, ["the"]))
    assert rows(running.metro_words_so_far(spark, path)) == expected and any("once" in r for r in expected)
    zones = metros.withColumn("properties", F.expr("map('STATE', 'st', 'COUNTY', properties['NAME10'])"))
    stream = spark.readStream.schema(POST_SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    running.add_state_county_words(stream, zones, counties, offsets + "2", ["the"]).awaitTermination()
    by_county = jobs.state_county_words(whole, zones, ["the"])
    assert rows(running.state_county_words_so_far(spark, counties)) == rows(by_county)

