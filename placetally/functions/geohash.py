"""Geohash cells and the coordinates a lookup by cell works with."""

import math

ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"
SNAP_MODES = ("rounded", "center", "exact")

# (lowest coordinate, extent) of each axis.
LON_AXIS = (-180.0, 360.0)
LAT_AXIS = (-90.0, 180.0)


def axis_bits(precision: int) -> tuple[int, int]:
    """Number of longitude and latitude bits in a cell id of ``precision`` characters."""
    return (5 * precision + 1) // 2, 5 * precision // 2


def known_decimals(extent: float, bits: int) -> int:
    """Decimals that are still certain when a coordinate is only known up to its cell."""
    half_cell = extent / 2 / (1 << bits)
    return max(1, round(-math.log10(half_cell))) - 1


def cell_index(coordinate: str, axis: tuple[float, float], bits: int) -> str:
    """Position of the cell along one axis.

    A coordinate exactly on an edge belongs to the lower cell, and one beyond
    the axis to the outermost cell.
    """
    low, extent = axis
    cells = 1 << bits
    scaled = f"({coordinate} - ({low}D)) / {extent}D * {float(cells)}D"
    return f"if({coordinate} is null, null, greatest(least(ceil({scaled}) - 1L, {cells - 1}L), 0L))"


def _digit(three: int, two: int) -> int:
    """Value of a character whose bits alternate between three of one axis and two of the other."""
    bits = (three >> 2, two >> 1, three >> 1, two, three)
    return sum((bit & 1) << (4 - i) for i, bit in enumerate(bits))


# Characters by the bits of the axis that comes first, then those of the other.
_CHARACTERS = "".join(ALPHABET[_digit(three, two)] for three in range(8) for two in range(4))


def cell_id(lon_index: str, lat_index: str, precision: int) -> str:
    """Base-32 cell id of two ``int`` positions: their bits interleaved, longitude first.

    Each character takes three bits of one axis and two of the other; the axes
    swap roles from one character to the next.
    """
    lon_bits, lat_bits = axis_bits(precision)
    axes = ((lon_index, lon_bits), (lat_index, lat_bits))
    characters = []
    for k in range(precision):
        (leading, leading_bits), (other, other_bits) = axes[k % 2], axes[1 - k % 2]
        three = f"(shiftright({leading}, {leading_bits - 5 * k // 2 - 3}) & 7)"
        two = f"(shiftright({other}, {other_bits - (5 * k + 1) // 2 - 2}) & 3)"
        characters.append(f"substr('{_CHARACTERS}', (shiftleft({three}, 2) | {two}) + 1, 1)")
    return f"concat({', '.join(characters)})"


def snapped(lon: str, lat: str, precision: int, snap: str = "rounded") -> tuple[str, str]:
    """Coordinates at which a lookup is made for a point.

    ``rounded``: the centre of the point's cell, rounded to the decimals known
    at that cell size (2 at precision 7, 3 at precision 8).
    ``center``: the centre itself.  ``exact``: the point itself.
    """
    if snap not in SNAP_MODES:
        raise ValueError(f"snap must be one of {SNAP_MODES}, not {snap!r}")
    if snap == "exact":
        return lon, lat
    placed = []
    for coordinate, axis, bits in zip((lon, lat), (LON_AXIS, LAT_AXIS), axis_bits(precision)):
        low, extent = axis
        center = f"({cell_index(coordinate, axis, bits)} + 0.5D) * {extent / (1 << bits)!r}D + ({low}D)"
        if snap == "rounded":
            center = f"round({center}, {known_decimals(extent, bits)})"
        placed.append(center)
    return placed[0], placed[1]
