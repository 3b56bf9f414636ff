"""Posts, map nodes and boundary layers derived from the test tables.

The tables hold no coordinates.  Every id gets a point by fixed arithmetic, and
every nation a county-sized outline and two metro areas.  ``oracles.py`` states
the same arithmetic in SQL.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Corners of an outline around its centre, counter-clockwise, in metres.
CORNERS = ((-450_000, -200_000), (400_000, -250_000), (450_000, 200_000), (-400_000, 250_000))
METRO_SCALE = 10
METRO_SHIFT = 150_000
# The tag keys of points of interest, and one that does not count.
TAG_KEYS = ("amenity", "builing", "shop", "office", "tourism", "building")
SOURCES = {
    "view": '<a href="http://twitter.com">Web</a>',
    "click": '<a href="http://instagram.com">Instagram</a>',
    "purchase": '<a href="http://foursquare.com">Foursquare</a>',
    "signup": '<a href="http://www.example.org">Example</a>',
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table with long texts.

    The small tables are a single file of one row group, which only one task can
    read; its rows are dealt to the cores.  Tables of several files stay put.
    """
    scan = table(spark, sf_dir, name).select(*columns)
    return scan.repartition(spark.sparkContext.defaultParallelism) if len(scan.inputFiles()) == 1 else scan


def lon_of(key: str) -> Column:
    return F.expr(f"-125D + ((({key} % 500) * 7919) % 58000) / 1000D + ({key} % 11) * 3e-4D")


def lat_of(key: str) -> Column:
    return F.expr(f"25D + ((({key} % 500) * 104729) % 24500) / 1000D + ({key} % 7) * 3e-4D")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A point per event."""
    key = "event_id"
    return table(spark, sf_dir, "events").select(
        "event_id", "event_type", "user_id", lon_of(key).alias("lon"), lat_of(key).alias("lat")
    )


def event_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as posts; the source follows from the event type and may be absent."""
    key = "event_id"
    source = F.lit(None).cast("string")
    for kind, anchor in SOURCES.items():
        source = F.when(F.col("event_type") == kind, F.lit(anchor)).otherwise(source)
    return table(spark, sf_dir, "events").select(
        "user_id",
        F.col("props").alias("description"),
        F.col(key).cast("string").alias("tweet_id"),
        source.alias("source"),
        F.array(lon_of(key), lat_of(key)).alias("lonlat"),
    )


def text_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents and conversation turns as posts."""
    key = "doc_id"
    documents = texts(spark, sf_dir, "documents", "doc_id", "source", "text").select(
        F.col(key).alias("user_id"),
        F.when(F.col(key) % 9 != 0, F.col("source")).alias("description"),
        "text",
        F.array(lon_of(key), lat_of(key)).alias("lonlat"),
    )
    turn = "(conv_id * 31 + turn)"
    turns = texts(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text").select(
        F.col("conv_id").alias("user_id"),
        F.col("role").alias("description"),
        "text",
        F.array(lon_of(turn), lat_of(turn)).alias("lonlat"),
    )
    return documents.unionByName(turns)


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as map nodes; one in six has only a tag that does not count, one in seven no name."""
    key = F.col("p_partkey")
    tag = F.element_at(F.array(*[F.lit(k) for k in TAG_KEYS]), (key % 6 + 1).cast("int"))
    kind = F.map_from_arrays(F.array(tag), F.array(F.col("p_type")))
    tags = F.when(
        key % 7 != 0, F.map_concat(kind, F.map_from_arrays(F.array(F.lit("name")), F.array(F.col("p_name"))))
    ).otherwise(kind)
    return table(spark, sf_dir, "part").select(
        key.alias("id"), tags.alias("tags"), F.array(lon_of("p_partkey"), lat_of("p_partkey")).alias("coordinates")
    )


def _centred(nations: DataFrame, shift: int = 0) -> DataFrame:
    return nations.withColumns({
        "cx": F.expr(f"{-2_000_000.0 + shift!r}D + (n_nationkey % 5) * 1000000D"),
        "cy": F.expr("-1200000D + (n_nationkey div 5) * 600000D"),
    })


def _features(centred: DataFrame, fid: str, scale: int, properties: str) -> DataFrame:
    corners = [(f"cx + ({dx / scale!r}D)", f"cy + ({dy / scale!r}D)") for dx, dy in CORNERS]
    edges = ", ".join(
        f"named_struct('x1', {x1}, 'y1', {y1}, 'x2', {x2}, 'y2', {y2})"
        for (x1, y1), (x2, y2) in zip(corners, corners[1:] + corners[:1])
    )
    xs, ys = (", ".join(axis) for axis in zip(*corners))
    return centred.selectExpr(
        f"cast({fid} as bigint) as fid",
        f"{properties} as properties",
        "true as areal",
        f"array({edges}) as edges",
        f"least({xs}) as minx",
        f"least({ys}) as miny",
        f"greatest({xs}) as maxx",
        f"greatest({ys}) as maxy",
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A county-like outline per nation."""
    properties = "map('STATE', cast(n_regionkey as string), 'COUNTY', n_name)"
    return _features(_centred(table(spark, sf_dir, "nation")), "n_nationkey", 1, properties)


def metros(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two metro areas per nation, near enough for their surroundings to overlap."""
    nations = table(spark, sf_dir, "nation")
    first = _features(_centred(nations), "n_nationkey", METRO_SCALE, "map('NAME10', concat(n_name, ' A'))")
    second = _features(
        _centred(nations, METRO_SHIFT), "n_nationkey + 100", METRO_SCALE, "map('NAME10', concat(n_name, ' B'))"
    )
    return first.unionByName(second)


# Size of a customer's area, and how many areas one boundary file holds.
AREA_SCALE = 4
AREAS_PER_FILE = 500


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey",
        "c_name",
        "-2000000D + ((c_custkey * 7919) % 4000) * 1000D as cx",
        "-1200000D + ((c_custkey * 104729) % 2400) * 1000D as cy",
    )


def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An overlapping area per customer."""
    return _features(_customers(spark, sf_dir), "c_custkey", AREA_SCALE, "map('NAME', c_name)")


def area_collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same areas as GeoJSON documents of a limited number of features each."""
    ring = ", ".join(f"array(cx + ({dx / AREA_SCALE!r}D), cy + ({dy / AREA_SCALE!r}D))" for dx, dy in (*CORNERS, CORNERS[0]))
    feature = (
        "to_json(named_struct('type', 'Feature', 'id', cast(c_custkey as string), 'properties', map('NAME', c_name),"
        f" 'geometry', named_struct('type', 'Polygon', 'coordinates', array(array({ring})))))"
    )
    files = (
        _customers(spark, sf_dir)
        .withColumn("feature", F.expr(feature))
        .groupBy(F.expr(f"c_custkey div {AREAS_PER_FILE}"))
        .agg(F.array_join(F.collect_list("feature"), ",").alias("features"))
    )
    return files.selectExpr("concat('{\"type\":\"FeatureCollection\",\"features\":[', features, ']}') as value")


def area_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The areas as one feature per line."""
    ring = ", ".join(f"array(cx + ({dx / AREA_SCALE!r}D), cy + ({dy / AREA_SCALE!r}D))" for dx, dy in (*CORNERS, CORNERS[0]))
    feature = (
        "to_json(named_struct('type', 'Feature', 'id', cast(c_custkey as string), 'properties', map('NAME', c_name),"
        f" 'geometry', named_struct('type', 'Polygon', 'coordinates', array(array({ring})))))"
    )
    return _customers(spark, sf_dir).select(F.expr(feature).alias("value"))


def write_layer(features: DataFrame, path: str) -> None:
    """Boundary features with one outline each as one GeoJSON collection."""
    ring = "concat(transform(edges, e -> array(e.x1, e.y1)), array(array(edges[0].x1, edges[0].y1)))"
    feature = (
        "to_json(named_struct('type', 'Feature', 'properties', properties,"
        f" 'geometry', named_struct('type', 'Polygon', 'coordinates', array({ring}))))"
    )
    ordered = F.array_sort(F.collect_list(F.struct("fid", F.expr(feature).alias("feature"))))
    joined = features.agg(F.array_join(F.transform(ordered, lambda f: f["feature"]), ",").alias("features"))
    joined.selectExpr("concat('{\"type\":\"FeatureCollection\",\"features\":[', features, ']}') as value").write.text(path)
