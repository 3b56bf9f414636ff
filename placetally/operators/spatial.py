"""Spatial joins as equi-joins on square tiles of the projected plane.

A feature has a row in every tile that its outline (grown by the search radius)
touches or that it covers, with the edges there and the parity of the tile's
corner, which says whether the corner is inside.  A point belongs to exactly one
tile, and the exact test runs on the pairs that share a tile: the way from the
point to the corner crosses edges of the tile only.  No pair is produced twice
and nothing is compared across tiles.
"""

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from placetally.functions import geohash, geometry, projection
from placetally.operators.known_places import KnownPlaces
from placetally.operators.quadtree import Quadtree, with_fine
from placetally.operators.skew import ROWS_PER_TASK, heaviest, split_join
from placetally.session import materialized

METERS_PER_MILE = 1609
METRO_DISTANCE_M = 50 * METERS_PER_MILE
POI_DISTANCE_M = 100
AREA_PRECISION = 7
POI_PRECISION = 8
COUNTY_TILE_M = 50_000
METRO_TILE_M = 100_000

COUNTY_PROPS = {"state": "STATE", "county": "COUNTY"}
METRO_PROPS = {"metro_area": "NAME10"}

# A lookup table of up to this size is broadcast; a larger one is joined by
# shuffle.  The size is that of the places found, measured when it is stored.
BROADCAST_BYTES = 64 << 20
# What a row takes besides its properties.
ROW_BYTES = 48
# Metres of a degree of latitude, and the least share of it that a degree of
# longitude has where the projection is of use.
DEGREE_M = 111_000
LEAST_LON_SHARE = 0.3

CELL_KEYS = ("cell_lon", "cell_lat")
# Helper columns of a join; they do not reach its result.
LOOKUP_KEYS = ("_lookup_lon", "_lookup_lat")
# Slack for rounding where a point sits on the edge of its tile.
TILE_SLACK_M = 1.0
# The corner whose parity a tile knows lies this far outside of it, within the
# slack and on no grid that an outline is likely to follow.
CORNER_M = (0.6180339887498949, -0.4142135623730951)
# Slack of bounds on distances, for rounding.
BOUND_SLACK_M = 1e-3


def with_cell(df: DataFrame, lon: str = "lon", lat: str = "lat", precision: int = AREA_PRECISION, name: str = "cell") -> DataFrame:
    """Add the id of the cell a point falls in."""
    lon_bits, lat_bits = geohash.axis_bits(precision)
    return (
        df.withColumns({
            "lon_index": F.expr(geohash.cell_index(lon, geohash.LON_AXIS, lon_bits)).cast("int"),
            "lat_index": F.expr(geohash.cell_index(lat, geohash.LAT_AXIS, lat_bits)).cast("int"),
        })
        .withColumn(name, F.expr(geohash.cell_id("lon_index", "lat_index", precision)))
        .drop("lon_index", "lat_index")
    )


def _with_pair(df: DataFrame, names: Sequence[str], expressions: Sequence[str]) -> DataFrame:
    return df.withColumns({name: F.expr(text) for name, text in zip(names, expressions)})


def with_snapped(
    df: DataFrame,
    lon: str = "lon",
    lat: str = "lat",
    precision: int = AREA_PRECISION,
    snap: str = "rounded",
    names: Sequence[str] = CELL_KEYS,
) -> DataFrame:
    """Add the coordinates at which the point is looked up."""
    return _with_pair(df, names, geohash.snapped(lon, lat, precision, snap))


def with_projected(df: DataFrame, lon: str = "lon", lat: str = "lat", names: Sequence[str] = ("x", "y")) -> DataFrame:
    """Add the point in metres of the projection."""
    return _with_pair(df, names, projection.project(lon, lat))


def with_unprojected(df: DataFrame, x: str = "x", y: str = "y", names: Sequence[str] = ("lon", "lat")) -> DataFrame:
    """Add longitude and latitude of a projected point."""
    return _with_pair(df, names, projection.unproject(x, y))


def _tile(coordinate: str, size: float) -> str:
    return f"nvl(floor({coordinate} / {float(size)!r}D), 0L)"


def _solid(df: DataFrame, *axes: str) -> DataFrame:
    """Make coordinates non-nullable: an unknown one becomes NaN, which is near nothing.

    Otherwise the optimizer derives null tests from the join, and these repeat
    the whole projection formula for every record ahead of the distinct step.
    """
    return df.withColumns({axis: F.expr(f"nvl({axis}, double('NaN'))") for axis in axes})


def _tiles_between(low: str, high: str, size: float) -> str:
    return f"explode(sequence({_tile(low, size)}, {_tile(high, size)}))"


def places_per_tile(precision: int, snap: str, tile_m: float) -> float:
    """How many lookup points a tile can hold: they lie on a grid, unless they are exact."""
    if snap == "exact":
        return math.inf
    steps = []
    for (_, extent), bits in zip((geohash.LON_AXIS, geohash.LAT_AXIS), geohash.axis_bits(precision)):
        step = extent / (1 << bits)
        if snap == "rounded":
            step = max(step, 10.0 ** -geohash.known_decimals(extent, bits))
        steps.append(step * DEGREE_M)
    return (tile_m / (steps[0] * LEAST_LON_SHARE) + 1) * (tile_m / steps[1] + 1)


def _corner(tile_m: float) -> tuple[str, str]:
    """The corner of tile ``(tx, ty)`` whose parity it knows."""
    tile = f"{float(tile_m)!r}D"
    return f"((tx + 1) * {tile} + {CORNER_M[0]!r}D)", f"(ty * {tile} + {CORNER_M[1]!r}D)"


def feature_tiles(features: DataFrame, props: Mapping[str, str], tile_m: float, reach_m: float) -> DataFrame:
    """One row per feature and tile: the edges within reach of the tile, and the ``parity`` of its corner.

    A tile that the feature covers has no edges and the parity 1; tiles with
    neither are left out.  So the edges of all tiles together grow with the
    length of the outline, and not with the tiles to the side of it.  The parity
    of a corner takes the edges of its row of tiles, which are found first.
    ``(anchor_x, anchor_y)`` is an end of the edge nearest to the middle of the tile.
    """
    reach, tile, margin = float(reach_m), float(tile_m), float(reach_m + TILE_SLACK_M)
    in_row = (
        f"greatest(e.y1, e.y2) >= ty * {tile!r}D - {margin!r}D"
        f" and least(e.y1, e.y2) <= (ty + 1) * {tile!r}D + {margin!r}D"
    )
    middle = (f"((tx + 0.5D) * {tile!r}D)", f"((ty + 0.5D) * {tile!r}D)")
    in_tile = geometry.near_box(*middle, f"{tile / 2 + margin!r}D")
    parity = geometry.corner_parity(*_corner(tile_m), "edges")
    ends = f"transform(edges, e -> struct(hypot(e.x1 - {middle[0]}, e.y1 - {middle[1]}) as d, e.x1 as x, e.y1 as y))"
    named = F.struct(*[F.col("properties")[key].alias(alias) for alias, key in props.items()])
    return (
        features.filter("size(edges) > 0")
        .withColumn("props", named)
        # rows of tiles first: each gets its own edges before it is cut into tiles
        .withColumn("ty", F.expr(_tiles_between(f"(miny - {reach!r}D)", f"(maxy + {reach!r}D)", tile)))
        .withColumn("edges", F.expr(f"filter(edges, e -> {in_row})"))
        .filter("size(edges) > 0")
        .withColumn("tx", F.expr(_tiles_between(f"(minx - {reach!r}D)", f"(maxx + {reach!r}D)", tile)))
        .withColumn("parity", F.expr(f"if(areal, {parity}, 0)"))
        .withColumn("edges", F.expr(f"filter(edges, e -> {in_tile})"))
        .filter("size(edges) > 0 or parity = 1")
        .withColumn("anchor", F.expr(f"array_min({ends})"))
        .select(
            "tx", "ty", "fid", "props", "areal", "parity", "edges", "minx", "miny", "maxx", "maxy",
            F.col("anchor.x").alias("anchor_x"), F.col("anchor.y").alias("anchor_y"),
        )
    )


def measured_pairs(
    placed: DataFrame, tiles: DataFrame, reach_m: float, keys: Sequence[str], bounded: bool, rows_per_task: int,
    sides: int | None = None,
) -> DataFrame:
    """Pairs of a place and a feature of its tile that an exact test has to decide; a place without one keeps a row.

    Without reach these are the features whose envelope has the place.  With it,
    no feature counts whose envelope is farther than the nearest anchor: a first
    pass over places and features without their edges finds that bound, and only
    the pairs below it meet the edges.  ``keys`` tell places apart.  Where the
    reach is a polygon, only an anchor that lies in it for certain is a bound.
    """

    def paired(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
        if bounded:
            return left.join(right, on, "left")
        return split_join(left, right, on, spread_by=keys, how="left", rows_per_task=rows_per_task)

    if reach_m <= 0:
        return paired(placed, tiles, ["tx", "ty"])
    heads = tiles.select("tx", "ty", "fid", "minx", "miny", "maxx", "maxy", "anchor_x", "anchor_y")
    near = paired(placed, heads, ["tx", "ty"]).withColumns({
        "least": F.expr(geometry.box_distance("x", "y")),
        # where a tile is covered there are no edges and no anchor, and the place is inside
        "most": F.expr("if(fid is null, null, nvl(hypot(anchor_x - x, anchor_y - y), 0D))"),
    })
    sure = "most"
    if sides is not None:
        sure = f"if(most <= {geometry.inner_radius(reach_m, sides) - BOUND_SLACK_M!r}D, most, double('Infinity'))"
    bound = F.min(F.expr(sure)).over(Window.partitionBy("tx", "ty", *keys))
    kept = near.withColumn("bound", bound).filter(f"fid is null or least <= bound + {BOUND_SLACK_M!r}D").select(
        *placed.columns, F.expr(f"if(least <= {float(reach_m + BOUND_SLACK_M)!r}D, fid, null)").alias("fid")
    )
    return paired(kept, tiles, ["tx", "ty", "fid"])


def nearest_feature(
    places: DataFrame,
    features: DataFrame,
    props: Mapping[str, str],
    reach_m: float,
    tile_m: float,
    keys: Sequence[str] = CELL_KEYS,
    bounded: bool = True,
    rows_per_task: int = ROWS_PER_TASK,
    sides: int | None = None,
) -> DataFrame:
    """Each place with the properties of the nearest feature within reach, null if there is none.

    ``places`` has one row per ``keys`` with projected ``x, y``; other columns
    are kept.  Reach 0 means containment, boundary included.  Of equally near
    features the one with the lowest ``fid`` wins; no two features may have the
    same ``fid``.

    ``bounded`` says that places lie on a grid, so that a tile holds a fixed
    number of them at most.  Otherwise crowded tiles are split.

    ``sides`` puts a polygon of so many sides in the place of the circle of
    reach: a feature counts if it meets the polygon.
    """
    reach = f"{float(reach_m)!r}D"
    kept = [c for c in places.columns if c not in ("x", "y")]
    placed = _solid(places, "x", "y").withColumns({"tx": F.expr(_tile("x", tile_m)), "ty": F.expr(_tile("y", tile_m))})
    tiles = feature_tiles(features, props, tile_m, reach_m)
    pairs = measured_pairs(placed, tiles, reach_m, keys, bounded, rows_per_task, sides)
    within = geometry.inside_from("x", "y", "edges", *_corner(tile_m), "parity")
    if reach_m > 0:
        measured = geometry.distance("x", "y", "edges", "areal", within)
        counts = f"dist <= {reach}"
        if sides is not None:
            sure = f"dist <= {geometry.inner_radius(reach_m, sides) - BOUND_SLACK_M!r}D"
            counts = f"{counts} and ({sure} or {geometry.meets_polygonal_circle('x', 'y', 'edges', reach_m, sides)})"
    else:
        counts = f"dist <= {reach}"
        in_bounds = "x between minx and maxx and y between miny and maxy"
        measured = f"if({in_bounds} and {geometry.covers('x', 'y', 'edges', 'areal', within)}, 0D, null)"
    # tx and ty follow from the keys; naming them lets the grouping reuse the
    # partitioning of the join.
    best = (
        pairs.withColumn("dist", F.expr(measured))
        .groupBy("tx", "ty", *kept)
        .agg(F.expr(f"min(if({counts}, struct(dist, fid, props), null))").alias("best"))
    )
    return best.select(*kept, *[F.col(f"best.props.{alias}").alias(alias) for alias in props])


@dataclass(frozen=True)
class PlaceLookup:
    """One stored row per distinct lookup point: its keys, properties and number of records ``n``.

    ``found`` counts the points that have a place, ``bytes`` is their size.
    ``misses`` counts the points that were measured, ``hits`` the records that
    found their point answered already, by another record or by an earlier run.
    """

    frame: DataFrame
    found: int
    bytes: int
    keys: tuple[str, ...]
    names: tuple[str, ...]
    hits: int = 0
    misses: int = 0

    def fits_broadcast(self, limit: int) -> bool:
        return self.bytes <= limit

    def places(self) -> DataFrame:
        return self.frame.filter(F.col(self.names[0]).isNotNull()).drop("n")


def lookup_places(
    cells: DataFrame,
    features: DataFrame,
    props: Mapping[str, str],
    reach_m: float,
    tile_m: float,
    keys: Sequence[str] = CELL_KEYS,
    snap: str = "rounded",
    rows_per_task: int = ROWS_PER_TASK,
    precision: int = AREA_PRECISION,
    known: str | None = None,
    sides: int | None = None,
) -> PlaceLookup:
    """Look up every distinct point once and keep the answers for all its records.

    A record is looked up at its snapped coordinates, so the work grows with the
    number of occupied cells and not with the number of records.  The count per
    cell is combined before its shuffle; a crowded cell is one row per task.
    A place with a missing or empty property counts as no place.  Points that
    lie on so fine a grid that a tile may hold more than a task's rows are
    split.  A Spark job runs at once: it stores the answers and measures them on
    the way.

    ``known`` is a folder of answers of earlier runs (``known_places``): only
    points that are not there are measured, and their answers are added to it.
    """
    counted = cells.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))

    def answers(points: DataFrame) -> DataFrame:
        located = nearest_feature(
            with_projected(points, *keys), features, props, reach_m, tile_m, keys,
            bounded=places_per_tile(precision, snap, tile_m) <= rows_per_task, rows_per_task=rows_per_task, sides=sides,
        )
        complete = " and ".join(f"{name} != ''" for name in props)
        rest = [c for c in points.columns if c not in keys]
        return located.select(*keys, *rest, *[F.expr(f"if({complete}, {name}, null)").alias(name) for name in props])

    misses = None
    if known is None:
        frame = answers(counted)
    else:
        frame, misses = KnownPlaces.of(known, features, props, reach_m, sides).completed(materialized(counted, "points"), keys, answers)
    size = sum((F.octet_length(name) for name in props), F.lit(ROW_BYTES))
    placed = F.col(next(iter(props))).isNotNull()
    # The last step before the write, so that a task that runs twice counts once.
    watch = Observation()
    stored = materialized(
        frame.observe(
            watch, F.count(F.when(placed, 1)).alias("found"), F.coalesce(F.sum(F.when(placed, size)), F.lit(0)).alias("bytes"),
            F.count(F.lit(1)).alias("points"), F.coalesce(F.sum("n"), F.lit(0)).alias("records"),
        ),
        "lookup",
    )
    seen = watch.get
    misses = seen["points"] if misses is None else misses
    return PlaceLookup(
        stored, seen["found"], seen["bytes"], tuple(keys), tuple(props), hits=seen["records"] - misses, misses=misses
    )


def attach_places(
    df: DataFrame,
    lookup: PlaceLookup,
    how: str = "inner",
    spread_by: Sequence[str] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Give each record the place of its lookup point.

    A lookup table of measured, small size is broadcast and the records stay
    where they are.  A larger one is joined by shuffle.  Crowded points, known
    from the lookup, are split then, whether they have a place or not.
    """
    keys = list(lookup.keys)
    if lookup.fits_broadcast(broadcast_bytes):
        return df.join(F.broadcast(lookup.places()), keys, how)
    hot = heaviest(lookup.frame, keys, rows_per_task, amount="n")
    return split_join(df, lookup.places(), keys, spread_by or df.columns, how, rows_per_task, hot)


def _join_places(points, features, props, reach_m, tile_m, lon, lat, precision, snap, how, broadcast_bytes, rows_per_task, known, sides=None):
    snapped = with_snapped(points, lon, lat, precision, snap, LOOKUP_KEYS)
    valid = snapped.filter(" and ".join(f"{key} is not null" for key in LOOKUP_KEYS))
    lookup = lookup_places(valid, features, props, reach_m, tile_m, LOOKUP_KEYS, snap, rows_per_task, precision, known, sides)
    records = snapped if how == "left" else valid
    joined = attach_places(records, lookup, how, broadcast_bytes=broadcast_bytes, rows_per_task=rows_per_task)
    return joined.drop(*LOOKUP_KEYS)


def join_containing(
    points: DataFrame,
    features: DataFrame,
    props: Mapping[str, str] = COUNTY_PROPS,
    lon: str = "lon",
    lat: str = "lat",
    precision: int = AREA_PRECISION,
    snap: str = "rounded",
    how: str = "inner",
    tile_m: float = COUNTY_TILE_M,
    broadcast_bytes: int = BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
    known: str | None = None,
) -> DataFrame:
    """Add properties of the feature that contains each point."""
    return _join_places(points, features, props, 0, tile_m, lon, lat, precision, snap, how, broadcast_bytes, rows_per_task, known)


def join_nearest(
    points: DataFrame,
    features: DataFrame,
    props: Mapping[str, str] = METRO_PROPS,
    max_distance_m: float = METRO_DISTANCE_M,
    lon: str = "lon",
    lat: str = "lat",
    precision: int = AREA_PRECISION,
    snap: str = "rounded",
    how: str = "inner",
    tile_m: float = METRO_TILE_M,
    broadcast_bytes: int = BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
    known: str | None = None,
    sides: int | None = None,
) -> DataFrame:
    """Add properties of the nearest feature within ``max_distance_m`` of each point.

    ``sides`` puts a polygon of so many sides in the place of the search circle.
    """
    return _join_places(
        points, features, props, max_distance_m, tile_m, lon, lat, precision, snap, how, broadcast_bytes, rows_per_task,
        known, sides,
    )


def join_within(
    spots: DataFrame,
    others: DataFrame,
    radius_m: float = POI_DISTANCE_M,
    on: Sequence[str] = (),
    spread_by: Sequence[str] = ("other_x", "other_y"),
    rows_per_task: int = ROWS_PER_TASK,
    spots_per_tile: float = 1.0,
    sides: int | None = None,
) -> DataFrame:
    """All ``others`` (``other_x, other_y``) within ``radius_m`` of each spot (``x, y``), with ``dist``.

    Both sides are in metres; ``on`` names columns that must be equal as well.
    ``sides`` puts a polygon of so many sides in the place of the circle.
    Pairs are found by tiles that are cut where ``others`` crowd (``quadtree``);
    their counts are taken at once, by a Spark job.  Spots should be distinct
    grid points: then a tile holds a fixed number of them, and the result grows
    with ``others`` only.  ``spots_per_tile`` is the number that a square of four
    radii can hold, so that a tile is measured by its pairs.
    """
    placed = with_fine(_solid(others, "other_x", "other_y"), "other_x", "other_y", radius_m)
    tree = Quadtree.of(placed, radius_m, on, rows_per_task, spots_per_tile)
    pairs = tree.joined(placed, _solid(spots, "x", "y"), spread_by)
    found = pairs.withColumn("dist", F.expr("hypot(other_x - x, other_y - y)")).filter(f"dist <= {float(radius_m)!r}D")
    if sides is not None:
        found = found.filter(geometry.in_polygonal_circle("other_x - x", "other_y - y", radius_m, sides))
    return found


def cell_reuse_stats(df: DataFrame, lon: str = "lon", lat: str = "lat", precision: int = AREA_PRECISION) -> DataFrame:
    """How many lookups find their cell already answered (hits) and how many are first (misses)."""
    cells = with_cell(df, lon, lat, precision).groupBy("cell").count()
    return cells.agg(
        F.coalesce(F.sum(F.col("count") - F.lit(1)), F.lit(0)).alias("hits"), F.count("cell").alias("misses")
    )
