import json
import math
import random
from collections import Counter

import pytest

from placetally import schemas
from placetally.plans import jobs
from tests.conftest import plan, rows
from tests.test_geo import KNOWN, square
from tests.test_spatial import POLYGON_1, POLYGON_2, WITHIN, layer, polygons
from tests.test_text import words_by_rule

FAR = (-80.0, 30.0)


def posts(spark, items):
    """Posts from (text, description, source, lonlat)."""
    full = [dict.fromkeys(schemas.POST_SCHEMA.names) | {"user_id": i, "tweet_id": str(i), "text": t, "description": d, "source": s, "lonlat": l}
            for i, (t, d, s, l) in enumerate(items)]
    return spark.createDataFrame([tuple(f[n] for n in schemas.POST_SCHEMA.names) for f in full], schemas.POST_SCHEMA)


def test_state_county_words(spark):
    items = [("#Foobar Foobaz (random!!) Galaxy??", "My Account", None, list(WITHIN))] * 5
    items += [("foobar", "good job", None, list(WITHIN))] * 9 + [("foobar", None, None, list(FAR))] * 9
    items += [("foobar", None, None, None), ("foobar the", None, None, list(KNOWN[2][:2]))]
    both = polygons(spark, one=POLYGON_1)
    got = rows(jobs.state_county_words(posts(spark, items), both, ["galaxy"]))
    expected = [(w, s, c, 5) for w in ("foobar", "foobaz", "random") for s, c in ((None, None), ("one", None), ("one", "one"))]
    assert got == sorted(expected, key=repr)


def test_place_with_empty_name_is_no_place(spark):
    df = posts(spark, [("word", None, None, list(WITHIN))] * 9)
    nameless = layer(spark, ("", "Polygon", [POLYGON_1]))
    assert jobs.state_county_words(df, nameless).count() == 0
    assert jobs.metro_words(df, nameless).count() == 0


@pytest.fixture(scope="module")
def crowded(spark):
    """A third of all posts at one place and with the same text."""
    rng = random.Random(11)
    vocabulary = ["alpha", "Beta!", "#gamma", "http://x.y", "the", "(delta)", "é", "@eps:"]
    items = [("copy of the same post", None, "twitter.com", list(WITHIN))] * 200
    items += [(" ".join(rng.choices(vocabulary, k=6)), rng.choice([None, "", "me", "a job"]), rng.choice(["twitter.com", "bot", None]),
               [rng.uniform(-123.2, -122.0), rng.uniform(45.2, 46.2)]) for _ in range(400)]
    return items


def test_metro_words_by_either_join(spark, crowded):
    metros = polygons(spark, m1=POLYGON_1, m2=POLYGON_2)
    df = posts(spark, crowded)
    small = jobs.metro_words(df, metros, ["the"])
    large = jobs.metro_words(df, metros, ["the"], broadcast_bytes=0, rows_per_task=3)
    assert rows(small) == rows(large)
    exact = jobs.metro_words(df, metros, ["the"], snap="exact")
    total = Counter(w for t, d, _, _ in crowded if "job" not in (d or "") for w in words_by_rule(t) if w != "the")
    assert {r.word for r in small.collect()} == set(total)
    got = Counter()
    for r in exact.collect():
        got[r.word] += r["count"]
    assert got == total  # every post lies within reach of a metro area
    assert "Python" not in plan(small) and "NestedLoop" not in plan(small)


def test_posts_are_read_once_where_the_join_is_shuffled(spark, crowded, tmp_path):
    path = str(tmp_path / "log")
    posts(spark, crowded).write.json(path)
    metros = polygons(spark, m1=POLYGON_1, m2=POLYGON_2)
    reads = spark.sparkContext.accumulator(0)

    def seen(value):
        reads.add(1)
        return value

    from pyspark.sql import functions as F
    counted = spark.read.schema(schemas.POST_SCHEMA).json(path).withColumn("text", F.udf(seen)("text"))
    got = jobs.metro_words(counted, metros, ["the"], broadcast_bytes=0)
    assert reads.value == len([i for i in crowded if "job" not in (i[1] or "")])
    assert rows(got) == rows(jobs.metro_words(posts(spark, crowded), metros, ["the"])) and path not in plan(got)


def project(lon, lat):
    from placetally.functions import projection as P
    phi = math.radians(lat)
    rho = P.APEX - P._arc(phi)
    theta = P.CONE * math.radians(lon - P.ORIGIN_LON)
    return rho * math.sin(theta), P.ORIGIN_RADIUS - rho * math.cos(theta)


def snap(lon, lat, precision, decimals):
    from tests.test_geo import bisected
    _, c_lon, c_lat = bisected(lon, lat, precision)
    return float(f"{c_lon:.{decimals}f}"), float(f"{c_lat:.{decimals}f}")


def test_poi_nearby_against_the_rule(spark, crowded):
    rng = random.Random(12)
    hot = crowded[0][3]
    places = [[hot[0] + rng.uniform(-0.003, 0.003), hot[1] + rng.uniform(-0.002, 0.002)] for _ in range(120)]
    places += [[l[0] + rng.uniform(-0.001, 0.001), l[1] + rng.uniform(-0.001, 0.001)] for _, _, _, l in crowded[200:]]
    pois = []
    for i, place in enumerate(places):
        tags = {rng.choice(["amenity", "builing", "shop", "building"]): "x"}
        if rng.random() < 0.8:
            tags["name"] = f"n{rng.randint(0, 30)}"
        pois.append((tags, place))
    poi_df = spark.createDataFrame(pois, schemas.POI_SCHEMA)
    x, y = KNOWN[0][2:]
    outlines = {"west": square(x - 40_000, y - 40_000, 40_000), "east": square(x, y - 40_000, 40_000)}
    metros = polygons(spark, **outlines)

    def metro(lonlat):
        px, py = project(*snap(*lonlat, 7, 2))
        def gap(box):
            (x1, y1), (x2, y2) = box[0], box[2]
            return math.hypot(max(x1 - px, 0, px - x2), max(y1 - py, 0, py - y2))
        name = min(outlines, key=lambda n: (gap(outlines[n]), list(outlines).index(n)))
        return name if gap(outlines[name]) <= 30_000 else None

    expected = Counter()
    for _, _, source, lonlat in crowded:
        if source != "twitter.com" or not metro(lonlat):
            continue
        px, py = project(*snap(*lonlat, 8, 3))
        names = set()
        for tags, place in pois:
            if "name" in tags and "building" not in tags and metro(place) == metro(lonlat):
                ox, oy = project(*place)
                if math.hypot(ox - px, oy - py) <= 100:
                    names.add(tags["name"])
        expected.update((metro(lonlat), n) for n in names)
    assert len(expected) > 20
    df = posts(spark, crowded)
    for kwargs in ({}, {"broadcast_bytes": 0, "rows_per_task": 5}):
        got = jobs.poi_nearby(df, poi_df, metros, max_distance_m=30_000, **kwargs)
        assert {(r.metro_area, r.poi): r["count"] for r in got.collect()} == expected


def test_poi_nearby_rejects_exact_points(spark):
    with pytest.raises(ValueError):
        jobs.poi_nearby(posts(spark, []), spark.createDataFrame([], schemas.POI_SCHEMA), polygons(spark, m=POLYGON_1), snap="exact")


def test_results_do_not_depend_on_partitions(spark, crowded):
    metros = polygons(spark, m1=POLYGON_1, m2=POLYGON_2)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    outcomes = []
    try:
        for n in ("1", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            outcomes.append(rows(jobs.metro_words(posts(spark, crowded).repartition(int(n)), metros)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert outcomes[0] == outcomes[1]


def test_poi_log(spark, tmp_path):
    nodes = spark.createDataFrame([(1, {"shop": "x", "name": "A"}, [1.0, 2.0]), (2, {"highway": "y"}, [1.0, 2.0])], schemas.NODE_SCHEMA)
    jobs.write_pois(nodes, str(tmp_path / "poi"))
    lines = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "poi")).collect()]
    assert lines == [{"tags": {"shop": "x", "name": "A"}, "coordinates": [1.0, 2.0]}]
