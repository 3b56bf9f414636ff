"""USA Contiguous Equidistant Conic projection (GRS80).

Formulas: J. P. Snyder, "Map Projections - A Working Manual" (USGS, 1987),
equidistant conic on the ellipsoid.  WGS84 and NAD83 are taken as identical.
"""

import math

# Projection parameters (degrees) and ellipsoid.
ORIGIN_LON = -96.0
ORIGIN_LAT = 39.0
PARALLELS = (33.0, 45.0)
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257222101

E2 = FLATTENING * (2 - FLATTENING)
# Coefficients of the meridian arc: latitude term, then sin(2k * latitude) for k = 1 to 4.
ARC = (
    1 - E2 / 4 - 3 * E2**2 / 64 - 5 * E2**3 / 256 - 175 * E2**4 / 16384,
    -(3 * E2 / 8 + 3 * E2**2 / 32 + 45 * E2**3 / 1024 + 105 * E2**4 / 4096),
    15 * E2**2 / 256 + 45 * E2**3 / 1024 + 525 * E2**4 / 16384,
    -(35 * E2**3 / 3072 + 175 * E2**4 / 12288),
    315 * E2**4 / 131072,
)


def _arc(latitude: float) -> float:
    waves = sum(c * math.sin(2 * k * latitude) for k, c in enumerate(ARC[1:], start=1))
    return SEMI_MAJOR * (ARC[0] * latitude + waves)


def _parallel_radius(latitude: float) -> float:
    return math.cos(latitude) / math.sqrt(1 - E2 * math.sin(latitude) ** 2)


_LOW, _HIGH = (math.radians(p) for p in PARALLELS)
CONE = SEMI_MAJOR * (_parallel_radius(_LOW) - _parallel_radius(_HIGH)) / (_arc(_HIGH) - _arc(_LOW))
APEX = SEMI_MAJOR * (_parallel_radius(_LOW) / CONE) + _arc(_LOW)
ORIGIN_RADIUS = APEX - _arc(math.radians(ORIGIN_LAT))

# Series that turns a rectifying latitude back into a geodetic one.
_E1 = (1 - math.sqrt(1 - E2)) / (1 + math.sqrt(1 - E2))
INVERSE_ARC = (
    3 * _E1 / 2 - 27 * _E1**3 / 32,
    21 * _E1**2 / 16 - 55 * _E1**4 / 32,
    151 * _E1**3 / 96,
    1097 * _E1**4 / 512,
)


def project(lon: str, lat: str) -> tuple[str, str]:
    """Longitude and latitude in degrees to x and y in metres."""
    waves = "".join(f" + ({c!r}D) * sin({2 * k} * radians({lat}))" for k, c in enumerate(ARC[1:], start=1))
    arc = f"({ARC[0]!r}D * radians({lat}){waves})"
    radius = f"({APEX!r}D - {SEMI_MAJOR!r}D * {arc})"
    angle = f"({CONE!r}D * radians({lon} - ({ORIGIN_LON!r}D)))"
    return f"{radius} * sin({angle})", f"{ORIGIN_RADIUS!r}D - {radius} * cos({angle})"


def unproject(x: str, y: str) -> tuple[str, str]:
    """x and y in metres back to longitude and latitude in degrees."""
    from_apex = f"({ORIGIN_RADIUS!r}D - {y})"
    rectifying = f"(({APEX!r}D - hypot({x}, {from_apex})) / {SEMI_MAJOR * ARC[0]!r}D)"
    waves = "".join(f" + {c!r}D * sin({2 * k} * {rectifying})" for k, c in enumerate(INVERSE_ARC, start=1))
    lon = f"degrees(atan2({x}, {from_apex}) / {CONE!r}D) + ({ORIGIN_LON!r}D)"
    return lon, f"degrees({rectifying}{waves})"
