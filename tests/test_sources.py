import json

import pytest
from pyspark.sql import functions as F

from placetally.operators import counts
from placetally.session import clear_scratch, materialized
from placetally.sources import boundaries, records, sinks
from tests.conftest import plan, rows
from tests.test_geo import square


def feature(name, kind="Polygon", coordinates=None, **more):
    return json.dumps({"type": "Feature", "properties": {"NAME": name}, "geometry": {"type": kind, "coordinates": coordinates} | more})


def test_feature_lines_are_numbered_over_files(spark, tmp_path):
    ring = [square(0, 0, 1)]
    for n, names in (("b", "de"), ("a", "abc")):
        (tmp_path / f"{n}.json").write_text("\n".join(["", *(feature(x, coordinates=ring) for x in names), "no feature"]))
    layer = boundaries.read_feature_lines(spark, str(tmp_path))
    got = sorted((r.fid, (r.properties or {}).get("NAME")) for r in layer.collect())
    assert got == [(0, "a"), (1, "b"), (2, "c"), (3, None), (4, "d"), (5, "e"), (6, None)]
    assert boundaries.without_edges(layer).count() == 2


def test_collections_in_several_files_have_numbers_of_their_own(spark, tmp_path):
    for n, names in (("2", "de"), ("1", "abc")):
        text = ",".join(feature(x, coordinates=[square(0, 0, 1)]) for x in names)
        (tmp_path / f"{n}.geojson").write_text(f'{{"type": "FeatureCollection", "features": [{text}]}}')
    layer = boundaries.read_features(spark, str(tmp_path), "UTF-8")
    assert sorted((r.fid, r.properties["NAME"]) for r in layer.collect()) == list(enumerate("abcde"))


def test_geometry_collection_has_the_edges_of_its_parts(spark, tmp_path):
    parts = [{"type": "Polygon", "coordinates": [square(0, 0, 1)]}, {"type": "Polygon", "coordinates": [square(5, 5, 1)]}]
    mixed = [parts[0], {"type": "LineString", "coordinates": [[0, 0], [9, 9]]}]
    lines = [feature("areas", "GeometryCollection", geometries=parts), feature("mixed", "GeometryCollection", geometries=mixed)]
    (tmp_path / "layer.json").write_text("\n".join(lines))
    areas, mix = boundaries.read_feature_lines(spark, str(tmp_path)).orderBy("fid").collect()
    assert areas.areal and len(areas.edges) == 8 and areas.maxx == 6.0
    assert not mix.areal and len(mix.edges) == 5 and mix.maxx == 9.0


def test_readers_keep_the_text_of_bad_lines(spark, tmp_path):
    (tmp_path / "log").write_text('{"user_id": 1}\n{"tags": {"shop": "x"}}\n{broken\n')
    posts, pois, unknown = records.read_mixed(spark, str(tmp_path / "log"))
    assert (posts.count(), pois.count()) == (1, 1)
    assert [r.rejected_line for r in unknown.collect()] == ["{broken"]
    bad = records.read_posts(spark, str(tmp_path / "log"), rejected="bad").cache()
    assert [r.bad for r in bad.filter("bad is not null").collect()] == ["{broken"]


def test_stop_words_leave_after_counting(spark):
    texts = spark.range(200).selectExpr("'the cat the dog' as text", "id")
    stop = spark.createDataFrame([("the",)], "word string")
    counted = counts.word_counts(texts, stopwords=stop, strategy="merge")
    assert rows(counted) == [("cat", 200), ("dog", 200)]
    text = plan(counted)
    assert "SortMergeJoin" in text
    # the count is combined before the words first move
    below = text[text.index("SortMergeJoin"):]
    assert below.index("partial_count") > below.index("hashpartitioning(word") and "Generate" not in below[: below.index("partial_count")]


def test_append_reads_only_the_metros_it_touches(spark, tmp_path):
    path = str(tmp_path / "results")
    table = spark.createDataFrame([("a", "x", 1), ("b", "x", 2), (None, "y", 3)], "metro_area string, word string, count bigint")
    sinks.write_results(table, path)
    more = spark.createDataFrame([("b", "x", 9), ("b", "z", 4), (None, "y", 5)], table.schema)
    existing = spark.read.schema(table.schema).parquet(path)
    pruned = sinks.touched(existing, more, "metro_area")
    assert sorted(r.word for r in pruned.collect()) == ["x", "y"]
    assert "PartitionFilters: [((metro_area" in plan(pruned)
    sinks.write_results(more.filter("metro_area is not null"), path, mode="append_ignore_duplicates")
    assert rows(sinks.read_results(spark, path, "word string, count bigint, metro_area string").select("metro_area", "word", "count")) == sorted(
        [("a", "x", 1), ("b", "x", 2), ("b", "z", 4), (None, "y", 3)], key=repr)


def test_documents_read_their_input_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("concat('m', id % 3) as metro_area", "cast(id as string) as word", "id as count").write.parquet(path)
    built = counts.documents_by_metro(spark.read.parquet(path), per_batch=7)
    assert path not in plan(built)
    assert built.select(F.sum(F.size("documents"))).first()[0] == 100


def test_scratch_is_removed(spark, tmp_path):
    stored = materialized(spark.range(5).toDF("x"))
    assert stored.count() == 5
    clear_scratch(spark)
    with pytest.raises(Exception):
        stored.count()


def test_append_computes_its_rows_once(spark, tmp_path):
    path, seen = str(tmp_path / "results"), spark.sparkContext.accumulator(0)
    schema = "metro_area string, word string, count bigint"
    sinks.write_results(spark.createDataFrame([("a", "x", 1)], schema), path)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    more = spark.createDataFrame([("a", "x", 9), ("a", "y", 2), ("b", "z", 4)], schema).mapInArrow(counted, schema)
    sinks.write_results(more, path, mode="append_ignore_duplicates")
    assert seen.value == 3
    table = sinks.read_results(spark, path, "word string, count bigint, metro_area string")
    assert rows(table.select("metro_area", "word", "count")) == [("a", "x", 1), ("a", "y", 2), ("b", "z", 4)]
