"""Tables of points laid out by cell: searches read the ranges of cells that their circle touches.

Cell ids, sorted as strings, follow a space-filling curve: their bits are those
of longitude and latitude in turn.  A table sorted by them keeps neighbours
together, and the least and greatest id of each row group tell a scan what to
skip.  Longitudes are taken to lie between -180 and 180 degrees.
"""

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placetally.functions import geohash
from placetally.functions.sphere import EARTH_RADIUS_M, great_circle_m, search_boxes
from placetally.operators.spatial import POI_PRECISION, with_cell

CELL = "cell"
# A cover ends at the level before it would have more cells than this.
COVER_CELLS = 64
# The first radius of a search for the nearest points, and its growth from one try to the next.
FIRST_M = 1_000.0
GROWTH = 4


def write_by_cell(
    df: DataFrame,
    path: str,
    lon: str = "lon",
    lat: str = "lat",
    precision: int = POI_PRECISION,
    spread_by: Sequence[str] | None = None,
    mode: str = "errorifexists",
) -> None:
    """Store points with their ``cell``, sorted by it over all files.

    Rows are dealt by ranges of the cell and of a hash of ``spread_by`` (by
    default all columns but maps), so a cell with very many rows takes several
    tasks; rows without a coordinate come first and are kept.
    """
    if spread_by is None:
        spread_by = [field.name for field in df.schema.fields if not isinstance(field.dataType, T.MapType)]
    placed = with_cell(df, lon, lat, precision, CELL)
    dealt = placed.repartitionByRange(CELL, F.xxhash64(*spread_by))
    dealt.sortWithinPartitions(CELL).write.mode(mode).parquet(path)


def _name(bits: int, precision: int) -> str:
    """Cell id of interleaved bits."""
    return "".join(geohash.ALPHABET[bits >> 5 * k & 31] for k in reversed(range(precision)))


def _indexes(low: float, high: float, axis: tuple[float, float], bits: int) -> tuple[int, int]:
    """First and last place along an axis of an interval, one more on both sides for rounding."""
    start, extent = axis
    first, last = (math.ceil((value - start) / extent * (1 << bits)) - 1 for value in (low, high))
    return min(max(first - 1, 0), (1 << bits) - 1), min(max(last + 1, 0), (1 << bits) - 1)


def cover(lon: float, lat: float, max_m: float, precision: int = POI_PRECISION, cells: int = COVER_CELLS) -> list[tuple[str, str]]:
    """Ranges of cell ids that hold all points up to ``max_m`` from a coordinate: at most ``cells`` of them.

    The plane is cut into halves by turns along both axes, like the bits of an
    id; parts that the box of the search does not touch are dropped.  At least
    two cells are needed, for a box across the date line.
    """
    widths = geohash.axis_bits(precision)
    total = sum(widths)
    boxes = [
        (_indexes(west, east, geohash.LON_AXIS, widths[0]), _indexes(south, north, geohash.LAT_AXIS, widths[1]))
        for west, south, east, north in search_boxes(lon, lat, max_m)
    ]

    def touches(part: tuple[int, int], done: tuple[int, int]) -> bool:
        spans = [(p << w - d, (p + 1 << w - d) - 1) for p, d, w in zip(part, done, widths)]
        return any(all(low <= b[1] and b[0] <= high for (low, high), b in zip(spans, box)) for box in boxes)

    # a part: its place along both axes and its interleaved bits
    parts, done = [((0, 0), 0)], (0, 0)
    for depth in range(total):
        axis = depth % 2
        done_next = (done[0] + (axis == 0), done[1] + (axis == 1))
        halves = []
        for place, bits in parts:
            for bit in (0, 1):
                half = (place[0] * 2 + bit, place[1]) if axis == 0 else (place[0], place[1] * 2 + bit)
                if touches(half, done_next):
                    halves.append((half, bits << 1 | bit))
        if len(halves) > max(cells, 2):
            break
        parts, done = halves, done_next
    rest = total - sum(done)
    ranges: list[list[int]] = []
    for _, bits in parts:  # in the order of the curve
        if ranges and ranges[-1][1] + 1 == bits:
            ranges[-1][1] = bits
        else:
            ranges.append([bits, bits])
    return [(_name(low << rest, precision), _name((high + 1 << rest) - 1, precision)) for low, high in ranges]


def within(
    table: DataFrame,
    lon: float,
    lat: float,
    max_m: float,
    lon_column: str = "lon",
    lat_column: str = "lat",
    precision: int = POI_PRECISION,
    distance: str = "distance_m",
) -> DataFrame:
    """Points of a table from ``write_by_cell`` up to ``max_m`` from a coordinate, with their distance, in no order.

    The ranges of cells are plain comparisons and reach the scan.
    """
    ranges = [F.col(CELL).between(low, high) for low, high in cover(lon, lat, max_m, precision)]
    touched = ranges[0]
    for further in ranges[1:]:
        touched = touched | further
    apart = great_circle_m(f"{float(lon)!r}D", f"{float(lat)!r}D", lon_column, lat_column)
    return table.filter(touched).withColumn(distance, F.expr(apart)).filter(F.col(distance) <= max_m)


def near(table: DataFrame, lon: float, lat: float, max_m: float, distance: str = "distance_m", **columns) -> DataFrame:
    """The same by rising distance."""
    return within(table, lon, lat, max_m, distance=distance, **columns).orderBy(distance)


def nearest(
    table: DataFrame,
    lon: float,
    lat: float,
    k: int,
    order: Sequence[str] = (),
    first_m: float = FIRST_M,
    distance: str = "distance_m",
    **columns,
) -> DataFrame:
    """The ``k`` nearest points of a table from ``write_by_cell`` by rising distance, equal ones by ``order``.

    A circle grows until it holds ``k`` points; then the k-th nearest is not
    farther than its radius, and nothing outside of it has to be read.  Each try
    is a Spark job over the ranges of its circle that stops at ``k`` rows.
    """
    if k < 1 or first_m <= 0:
        raise ValueError("k must be 1 at least and the first radius above 0")
    reach, around = float(first_m), math.pi * EARTH_RADIUS_M * (1 + 1e-9)
    while reach < around and within(table, lon, lat, reach, distance=distance, **columns).limit(k).count() < k:
        reach *= GROWTH
    return within(table, lon, lat, min(reach, around), distance=distance, **columns).orderBy(distance, *order).limit(k)
