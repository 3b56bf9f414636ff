import json
import random

import pytest

from placetally.sources.boundaries import read_features
from placetally.sources.split_collections import read_split_features, split_members
from tests.test_geo import square


@pytest.fixture
def small_blocks(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def collection(rng, n, **more):
    names = ['brace } in {text}', 'quote " and \\', "\\\\", "été", '"features": [{', "], [", "{" * 5, "", "long " * 300]
    features = []
    for i in range(n):
        shape = rng.choice(["Polygon", "MultiPolygon", "Point", None, "GeometryCollection"])
        at = square(rng.randint(0, 90), rng.randint(0, 90), 5)
        geometry = shape and {"type": shape, "coordinates": {"Polygon": [at], "MultiPolygon": [[at], [at]], "Point": at[0]}.get(shape)}
        if shape == "GeometryCollection":
            geometry = {"type": shape, "geometries": [{"type": "Polygon", "coordinates": [at]}, {"type": "Point", "coordinates": at[0]}]}
        features.append({"type": "Feature", "id": str(i), "properties": {"NAME": rng.choice(names), "n": f"{i}"}, "geometry": geometry})
    return {"type": "FeatureCollection", **more, "features": features}


def content(df):
    return [tuple(r[c] for c in ("id", "properties", "areal", "edges", "minx", "maxy")) for r in df.orderBy("fid").collect()]


@pytest.mark.parametrize("encoding", ["ISO-8859-1", "UTF-8"])
def test_one_document_read_by_many_tasks(spark, tmp_path, small_blocks, encoding):
    rng = random.Random(3)
    crs = {"type": "name", "properties": {"name": "a { b"}}
    documents = [
        json.dumps(collection(rng, 40), ensure_ascii=False), json.dumps(collection(rng, 30, crs=crs, note='x "features": [ y'), indent=2, ensure_ascii=False),
        json.dumps(collection(rng, 1)), json.dumps(collection(rng, 0)),
        json.dumps({**collection(rng, 5, links=[{"a": 1}, {"b": [2, {"c": 3}]}]), "more": [{"x": {}}, {"y": 1}], "end": {"z": []}}) + "\n\n",
    ]
    for k, text in enumerate(documents):
        (tmp_path / f"{k}.geojson").write_bytes(text.encode(encoding))
    got = read_split_features(spark, str(tmp_path), encoding)
    assert [r.fid for r in got.orderBy("fid").collect()] == list(range(76))
    assert content(got) == content(read_features(spark, str(tmp_path), encoding))
    members = split_members(spark, str(tmp_path / "0.geojson"), encoding)
    assert members.select("block").distinct().count() > 5


def test_wide_encodings_are_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        split_members(spark, str(tmp_path), "UTF-16")
