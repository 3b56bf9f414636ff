import json

import pytest
from pyspark.sql import functions as F

from placetally.operators import counts, results
from placetally.sources import sinks
from tests.conftest import plan, rows

RESULTS = [("P", "a", 3), ("P", "b", 5), ("P", "c", 5), ("S", "a", 9)]


def table(spark, data=RESULTS):
    return spark.createDataFrame(data, "metro_area string, word string, count bigint")


def test_rollup_minimum_per_level(spark):
    words = [("w", "s1", "c1")] * 4 + [("w", "s1", "c2")] * 3 + [("w", "s2", "c1")] * 2 + [("v", "s1", "c1")] * 4
    df = spark.createDataFrame(words, "word string, state string, county string")
    assert rows(counts.word_rollup(df)) == [("w", "s1", None, 7), ("w", None, None, 9)]
    weighted = df.groupBy("word", "state", "county").agg(F.count("*").alias("n"))
    assert rows(counts.word_rollup(weighted, min_count=4, weight="n")) == rows(counts.word_rollup(df, min_count=4))
    assert counts.word_rollup(df, min_count=4).count() == 6


def test_metro_minimum(spark):
    df = spark.createDataFrame([("P", "a"), ("P", "a"), ("P", "b"), ("S", "a")], "metro_area string, word string")
    assert rows(counts.metro_word_count(df)) == [("P", "a", 2)]


def test_partial_aggregation_before_the_shuffle(spark):
    text = plan(counts.count_groups(table(spark), ["word"]))
    assert text.index("partial_count") > text.index("Exchange")  # printed top-down


def test_documents_in_batches(spark):
    data = [("P", f"w{i}", i) for i in range(1000)] + [("S", "a", 1)]
    batches = counts.documents_by_metro(table(spark, data), per_batch=100)
    got = batches.collect()
    assert sorted(len(r.documents) for r in got)[-1] < 160
    assert len([r for r in got if r.metro_area == "P"]) == 10
    assert all([d.word for d in r.documents] == sorted(d.word for d in r.documents) for r in got)
    assert sorted((r.metro_area, d.word, d["count"]) for r in got for d in r.documents) == sorted(data)


def test_queries_on_results(spark):
    df = table(spark)
    assert rows(results.distinct_metros(df)) == [("P",), ("S",)]
    assert [r.word for r in results.top_for_metro(df, "P").collect()] == ["b", "c", "a"]
    assert [r.word for r in results.top_for_metro(df, "P", 1).collect()] == ["b"]
    assert results.find(df).count() == 4 and results.find(df, limit=0).count() == 4
    assert results.find(df, "count >= 5", 2).count() == 2
    assert results.find(df, F.col("word") == "a").count() == 2


def test_near(spark):
    df = spark.createDataFrame([(1, -122.6, 45.5), (2, -122.7, 45.5), (3, 10.0, 45.5)], "id int, lon double, lat double")
    assert [r.id for r in results.near(df, -122.69, 45.5).collect()] == [2, 1, 3]
    assert [r.id for r in results.near(df, -122.69, 45.5, 5_000).collect()] == [2]
    assert results.near(df, -122.69, 45.5, 0).count() == 3


def test_insert_ignore(spark):
    new = table(spark, [("P", "a", 1), ("Q", "z", 8), ("Q", "z", 7)])
    both = results.insert_ignore(table(spark), new, ["metro_area", "word"])
    assert rows(both) == sorted(RESULTS + [("Q", "z", 7)])
    keys_only = results.insert_ignore(table(spark).select("word"), new.select("word"), ["word"])
    assert rows(keys_only) == [("a",), ("a",), ("b",), ("c",), ("z",)]


def test_sorted_by_metro(spark):
    df = spark.createDataFrame([("P", 2), ("Q", 1), ("P", 1)], "metro_area string, type_tag int")
    assert [tuple(r) for r in results.sorted_by_metro(df).collect()] == [("P", 1), ("P", 2), ("Q", 1)]


def test_tsv(spark, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_tsv(table(spark), "metro_words", path)
    assert rows(spark.read.text(path)) == [("P\t3\ta",), ("P\t5\tb",), ("P\t5\tc",), ("S\t9\ta",)]
    rolled = spark.createDataFrame([("w", None, None, 7), ("w", "41", None, 6), ("w", "41", "051", 5)],
                                   "word string, state string, county string, count bigint")
    sinks.write_tsv(rolled, "state_county_words", path)
    assert rows(spark.read.text(path)) == [("w\t41\t051\t5",), ("w\t41\tNone\t6",), ("w\tNone\tNone\t7",)]
    poi = spark.createDataFrame([("P", "Cafe", 2)], "metro_area string, poi string, count bigint")
    assert rows(sinks.as_tsv(poi, "poi_nearby")) == [("P\t2\tCafe",)]


def read_back(spark, path):
    df = sinks.read_results(spark, path, "word string, count bigint, metro_area string")
    return rows(df.select("metro_area", "word", "count"))


def test_result_table(spark, tmp_path):
    path = str(tmp_path / "table")
    sinks.write_results(table(spark), path)
    sinks.write_results(table(spark), path)
    assert read_back(spark, path) == sorted(RESULTS)
    sinks.write_results(table(spark, [("P", "a", 7), ("Portland, OR--WA", "new", 1)]), path, "append_ignore_duplicates")
    assert read_back(spark, path) == sorted(RESULTS + [("Portland, OR--WA", "new", 1)])
    sinks.write_results(table(spark, [("P", "a", 7)]), path, "append")
    assert len(read_back(spark, path)) == 6
    with pytest.raises(ValueError):
        sinks.write_results(table(spark), path, "upsert")


def test_first_append_creates_the_table(spark, tmp_path):
    path = str(tmp_path / "fresh")
    sinks.write_results(table(spark, RESULTS + [("P", "a", 1)]), path, "append_ignore_duplicates")
    assert read_back(spark, path) == sorted([("P", "a", 1), *RESULTS[1:]])
