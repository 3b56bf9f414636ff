"""Boundary layers: GeoJSON feature collections in projected metres."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from placetally.functions import geometry
from placetally.session import materialized

DEFAULT_ENCODING = "ISO-8859-1"

# The geometry stays JSON text until its type says how deep the arrays nest.
_COLLECTION = (
    "features array<struct<id:string, properties:map<string,string>,"
    " geometry:struct<type:string, coordinates:string, geometries:array<struct<type:string, coordinates:string>>>>>"
)
_FEATURE = _COLLECTION.removeprefix("features array<").removesuffix(">")
_POINT = "array<double>"
_LINE = f"array<{_POINT}>"
_RINGS = f"array<{_LINE}>"
_PARTS = f"array<{_RINGS}>"


def _edges(kind: str, coordinates: str) -> str:
    """Edges of any geometry; null where the type is unknown or the text is not of that type."""

    def parsed(shape: str) -> str:
        return f"from_json({coordinates}, '{shape}')"

    def each(parts: str, edges: str) -> str:
        return f"flatten(transform({parts}, part -> {edges}))"

    ring, line, point = geometry.ring_edges("part"), geometry.line_edges("part"), geometry.point_edges("part")
    return f"""case {kind}
        when 'Polygon' then {each(parsed(_RINGS), ring)}
        when 'MultiPolygon' then {each(f"flatten({parsed(_PARTS)})", ring)}
        when 'LineString' then {each(f"array({parsed(_LINE)})", line)}
        when 'MultiLineString' then {each(parsed(_RINGS), line)}
        when 'Point' then {each(f"array({parsed(_POINT)})", point)}
        when 'MultiPoint' then {each(parsed(_LINE), point)}
    end"""


def as_features(raw: DataFrame) -> DataFrame:
    """``(fid, id, properties, geometry_type, coordinates)`` to features with edges and bounds.

    ``coordinates`` is JSON text.  With a column ``geometries`` of types and
    coordinates, a collection of geometries has the edges of all of them; it is
    an area if all of them are.  A feature whose geometry is missing or broken
    has no edges and no bounds, and so never matches; see ``without_edges``.
    """
    areal, edges = "coalesce(geometry_type in ('Polygon', 'MultiPolygon'), false)", _edges("geometry_type", "coordinates")
    if "geometries" in raw.columns:
        of_each = f"flatten(transform(geometries, g -> {_edges('g.type', 'g.coordinates')}))"
        edges = f"if(geometry_type = 'GeometryCollection', {of_each}, {edges})"
        areal = (
            "if(geometry_type = 'GeometryCollection',"
            f" coalesce(forall(geometries, g -> g.type in ('Polygon', 'MultiPolygon')), false), {areal})"
        )
    built = raw.select("fid", "id", "properties", F.expr(areal).alias("areal"), F.expr(edges).alias("edges"))
    # An outline with an unreadable corner is no outline.
    broken = "exists(edges, e -> e.x1 is null or e.y1 is null or e.x2 is null or e.y2 is null)"
    return with_bounds(built.withColumn("edges", F.expr(f"if({broken}, null, edges)")))


def without_edges(features: DataFrame) -> DataFrame:
    """The features that can never match, for counting or for a look at them."""
    return features.filter("edges is null or size(edges) = 0")


def with_bounds(features: DataFrame) -> DataFrame:
    """Add the envelope of each feature's edges."""
    return features.withColumns({name: F.expr(text) for name, text in geometry.envelope("edges").items()})


def read_features(spark: SparkSession, path: str | list[str], encoding: str = DEFAULT_ENCODING) -> DataFrame:
    """One row per feature of one or more collections; ``fid`` is its place in them, file after file by name.

    A collection is one JSON document, so one task reads its text; a large layer
    is better kept as lines (``read_feature_lines``).  The features are stored
    once before their geometries are parsed.
    """
    document = spark.read.schema(_COLLECTION).option("multiLine", True).option("encoding", encoding).json(path)
    raw = document.select(F.col("_metadata.file_path").alias("file"), F.posexplode("features").alias("at", "feature"))
    return _numbered(materialized(raw.select("file", F.lit(0).cast("bigint").alias("block"), "at", "feature"), "layer"))


def read_feature_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per feature of files with one feature per line (UTF-8), read by many tasks.

    ``fid`` is the place of the line, file after file by name.  A line that is no
    feature keeps its place and has no edges; blank lines do not count.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.from_json("value", _FEATURE).alias("feature"), "value",
    )
    return _numbered(materialized(lines.filter("trim(value) <> ''").drop("value"), "layer"))


def _numbered(raw: DataFrame) -> DataFrame:
    """Features with numbers in order of file, block of the file and place in it; blank lines between them leave gaps.

    The running count goes over the blocks, of which there is one per task that
    has read the files, and not over the features.
    """
    blocks = raw.groupBy("file", "block").agg(F.min("at").alias("first"), F.max("at").alias("last"))
    before = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    width = F.col("last") - F.col("first") + 1
    placed = raw.join(blocks.select("file", "block", "first", F.coalesce(F.sum(width).over(before), F.lit(0)).alias("start")), ["file", "block"])
    return as_features(placed.select(
        (F.col("start") + F.col("at") - F.col("first")).cast("bigint").alias("fid"),
        "feature.id",
        "feature.properties",
        F.col("feature.geometry.type").alias("geometry_type"),
        F.col("feature.geometry.coordinates").alias("coordinates"),
        F.col("feature.geometry.geometries").alias("geometries"),
    ))
