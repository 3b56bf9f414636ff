import json

import pytest
from pyspark.sql import functions as F

from placetally import schemas
from placetally.operators import filters
from placetally.sources import records
from tests.conftest import rows

USER = {"id": 1, "name": "n", "screen_name": "s", "description": None, "location": None, "friends_count": 2, "followers_count": 3}
STATUS = {"user": USER, "text": "hi", "id_str": "9", "source": "web", "created_at": "Thu", "timestamp_ms": "1458802934188",
          "coordinates": {"type": "Point", "coordinates": [-122.5, 45.5]}}


def statuses(spark, tmp_path, *items):
    path = tmp_path / "statuses.json"
    path.write_text("\n".join(json.dumps(i) for i in items))
    return spark.read.schema(schemas.STATUS_SCHEMA).json(str(path))


def test_located_statuses(spark, tmp_path):
    items = [{}, {"coordinates": None, "user": None}, {"coordinates": None, "user": USER}, {"user": {}, "coordinates": STATUS["coordinates"]},
             {"user": USER, "coordinates": {}}, STATUS]
    kept = filters.filter_located(statuses(spark, tmp_path, *items))
    assert [r.id_str for r in kept.collect()] == ["9"]


def test_extraction(spark, tmp_path):
    posts = filters.apply_steps(statuses(spark, tmp_path, STATUS), filters.filter_located, filters.extract_fields)
    assert posts.columns == schemas.POST_SCHEMA.names
    assert [f.dataType for f in posts.schema] == [f.dataType for f in schemas.POST_SCHEMA]
    assert posts.first() == (1, "n", "s", None, None, 2, 3, "hi", "9", "web", "Thu", "1458802934188", [-122.5, 45.5])
    assert str(records.with_timestamp(posts).first().ts) == "2016-03-24 07:02:14.188000"


def test_bbox(spark):
    df = spark.createDataFrame([(1, [-122.5, 45.5]), (2, [-125.0011, 24.9493]), (3, [0.0, 45.0]), (4, None), (5, [-100.0])],
                               "id int, lonlat array<double>")
    assert [r.id for r in filters.filter_bbox(df).collect()] == [1, 2]
    assert [r.id for r in filters.filter_bbox(df, filters.PORTLAND).collect()] == [1]
    assert [r.id for r in filters.filter_bbox(df, " -1, 44 , 1,46").collect()] == [3]
    with pytest.raises(ValueError):
        filters.filter_bbox(df, "1,2,3")


def test_exclude_terms(spark):
    texts = [None, "", "My Account", "good job", "jobs", "Job board", "we are hiring", "careers", "HIRING"]
    df = spark.createDataFrame([(t,) for t in texts], "description string")
    assert [r[0] for r in filters.exclude_terms(df).collect()] == [None, "", "My Account", "Job board", "HIRING"]
    assert filters.exclude_terms(df, terms=[]).count() == len(texts)


def test_allow_sources(spark):
    texts = [None, "", '<a href="http://twitter.com/x">', "instagram.com", "twitterXcom", "untappd.com", "foursquare.com"]
    df = spark.createDataFrame([(t,) for t in texts], "source string")
    assert filters.allow_sources(df).count() == 4
    assert filters.allow_sources(df, domains=[]).count() == 0


NODES = [
    (1, {"amenity": "cafe", "name": "Stump"}, [1.0, 2.0]), (2, {"shop": "yes"}, [1.0, 2.0]),
    (3, {"building": "yes", "name": "B"}, [1.0, 2.0]), (4, {"builing": "yes", "name": "C"}, [3.0, 2.0]),
    (5, {"name": "D"}, [1.0, 2.0]), (6, {}, [1.0, 2.0]), (7, None, [1.0, 2.0]), (8, {"office": None, "name": ""}, [1.0, 2.0]),
]


def test_points_of_interest(spark):
    nodes = spark.createDataFrame(NODES, schemas.NODE_SCHEMA)
    pois = filters.filter_poi_nodes(nodes)
    assert pois.columns == ["tags", "coordinates"]
    assert pois.count() == 4
    assert rows(filters.named_pois(pois)) == rows(filters.named_pois(nodes))
    assert [r.name for r in filters.named_pois(nodes).collect()] == ["Stump", "C", ""]
    assert filters.filter_poi_nodes(nodes, ["building"]).count() == 1


def test_invalid_lookup_points(spark):
    df = spark.createDataFrame([(1, None), (2, [200.0, -100.0, 500.0]), (3, [None, 1.0]), (4, [5.0, 6.0])], "id int, lonlat array<double>")
    assert rows(filters.with_lonlat(df).select("id", "lon", "lat")) == [(4, 5.0, 6.0)]


def test_mixed_input(spark, tmp_path):
    lines = [{"user_id": 1, "text": "t", "lonlat": [1.0, 2.0]}, {"tags": {"shop": "x"}, "coordinates": [3.0, 4.0]},
             {"tags": {}, "user_id": 2, "coordinates": [5.0, 6.0]}, {"text": "neither"}]
    (tmp_path / "a.log").write_text("\n".join(map(json.dumps, lines[:2])))
    (tmp_path / "b.log").write_text("\n".join(map(json.dumps, lines[2:])))
    posts, pois, rejected = records.read_mixed(spark, [str(tmp_path / "a.log"), str(tmp_path / "b.log")])
    assert [r.user_id for r in posts.collect()] == [1] and posts.columns == schemas.POST_SCHEMA.names
    assert rows(pois.select("coordinates")) == [([3.0, 4.0],), ([5.0, 6.0],)]
    assert [r.text for r in rejected.collect()] == ["neither"]
    both = records.union_records(posts, pois)
    assert both.count() == 3 and both.filter(F.col("tags").isNull()).count() == 1


def test_readers(spark, tmp_path):
    (tmp_path / "stop.txt").write_text("the\nof\nthe\n")
    assert rows(records.read_stopwords(spark, str(tmp_path / "stop.txt"))) == [("of",), ("the",)]
    (tmp_path / "p.json").write_text(json.dumps({"user_id": 5, "lonlat": [1, 2.5], "other": 1}))
    assert records.read_posts(spark, str(tmp_path / "p.json")).select("user_id", "lonlat").first() == (5, [1.0, 2.5])
    (tmp_path / "n.json").write_text(json.dumps({"id": 1, "tags": {"shop": "x"}, "coordinates": [1, 2]}))
    assert records.read_nodes(spark, str(tmp_path / "n.json")).first().id == 1
    assert records.read_pois(spark, str(tmp_path / "n.json")).columns == ["tags", "coordinates"]
