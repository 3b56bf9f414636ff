"""Queries on result tables and on points."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placetally.functions import geometry, projection
from placetally.functions.sphere import great_circle_m, search_boxes


def distinct_metros(results: DataFrame, metro: str = "metro_area") -> DataFrame:
    return results.select(metro).distinct()


def top_for_metro(
    results: DataFrame, place: str, n: int | None = None, metro: str = "metro_area", label: str = "word"
) -> DataFrame:
    """Results of one metro by falling count; equal counts by label."""
    ordered = results.filter(F.col(metro) == place).orderBy(F.desc("count"), label)
    return ordered.limit(n) if n else ordered


def find(df: DataFrame, predicate: Column | str | None = None, limit: int | None = None) -> DataFrame:
    """Rows that satisfy the predicate, if any; no limit (or 0) means all of them."""
    found = df if predicate is None else df.filter(predicate)
    return found.limit(limit) if limit else found


def near(
    df: DataFrame,
    lon: float,
    lat: float,
    max_m: float | None = None,
    lon_column: str = "lon",
    lat_column: str = "lat",
    distance: str = "distance_m",
) -> DataFrame:
    """Points by rising great-circle distance from a coordinate, optionally only up to ``max_m``.

    Points without a coordinate are near nothing and left out.

    The box of the search is made of plain ranges on both columns, which reach
    the scan.  ``cell_tables`` has the same search, and one for the nearest, on
    tables that are laid out for it.
    """
    if max_m:
        boxes = search_boxes(lon, lat, max_m)
        df = df.filter(F.col(lat_column).between(boxes[0][1], boxes[0][3]))
        if boxes[0][::2] != (-180.0, 180.0):
            # the distance takes longitudes of any turn, so does the box
            across = (F.col(lon_column) < -180.0) | (F.col(lon_column) > 180.0)
            for west, _, east, _ in boxes:
                across = across | F.col(lon_column).between(west, east)
            df = df.filter(across)
    else:
        df = df.filter(F.col(lon_column).isNotNull() & F.col(lat_column).isNotNull())
    apart = great_circle_m(f"{float(lon)!r}D", f"{float(lat)!r}D", lon_column, lat_column)
    measured = df.withColumn(distance, F.expr(apart))
    if max_m:
        measured = measured.filter(F.col(distance) <= max_m)
    return measured.orderBy(distance)


def _search_box(lon: float, lat: float, reach: float) -> tuple[str, str, str]:
    """The coordinate in metres, and the test whether the grown bounds of a feature hold it."""
    x, y = (f"({text})" for text in projection.project(f"{float(lon)!r}D", f"{float(lat)!r}D"))
    box = f"{x} between minx - {reach!r}D and maxx + {reach!r}D and {y} between miny - {reach!r}D and maxy + {reach!r}D"
    return x, y, box


def near_features(features: DataFrame, lon: float, lat: float, max_m: float | None = None) -> DataFrame:
    """Boundary features by rising distance from a coordinate, in metres of the projection."""
    x, y, box = _search_box(lon, lat, float(max_m or 0))
    if max_m:
        features = features.filter(box)
    measured = features.withColumn("distance_m", F.expr(geometry.distance(x, y, "edges", "areal")))
    limit = f"distance_m <= {float(max_m)!r}D" if max_m else "distance_m is not null"
    return measured.filter(limit).orderBy("distance_m", "fid")


def intersecting(features: DataFrame, lon: float, lat: float) -> DataFrame:
    """Boundary features that contain a coordinate, boundary included."""
    x, y, box = _search_box(lon, lat, 0.0)
    return features.filter(box).filter(geometry.covers(x, y, "edges", "areal"))


def insert_ignore(existing: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """``existing`` plus those rows of ``new`` whose key it lacks."""
    return existing.unionByName(fresh_rows(existing, new, key))


def fresh_rows(existing: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``new`` with an unknown key; of rows with the same key the smallest one.

    Both sides are reduced to one row per key before they meet.
    """
    key = list(key)
    rest = [c for c in new.columns if c not in key]
    if rest:
        one_each = new.groupBy(*key).agg(F.min(F.struct(*rest)).alias("row")).select(*key, "row.*")
    else:
        one_each = new.select(*key).distinct()
    return one_each.join(existing.select(*key).distinct(), key, "left_anti").select(*new.columns)


def sorted_by_metro(records: DataFrame, metro: str = "metro_area", order: Sequence[str] = ("type_tag",)) -> DataFrame:
    """Records grouped by metro and ordered within it.

    The sort is by ranges of the whole key, so a large metro spans many tasks.
    """
    return records.orderBy(metro, *order)
