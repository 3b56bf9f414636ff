"""Distances on the sphere."""

import math

EARTH_RADIUS_M = 6378100.0


def great_circle_m(lon1: str, lat1: str, lon2: str, lat2: str, radius: float = EARTH_RADIUS_M) -> str:
    """Haversine distance in metres between coordinates in degrees; null if one is unknown."""
    across = f"pow(sin(radians({lon2} - ({lon1})) / 2), 2) * cos(radians({lat1})) * cos(radians({lat2}))"
    along = f"pow(sin(radians({lat2} - ({lat1})) / 2), 2)"
    square = f"({along} + {across})"
    # rounding may lead beyond 1; least() would take an unknown value for 1
    return f"{2 * radius!r}D * asin(sqrt(if({square} > 1D, 1D, {square})))"


def search_boxes(lon: float, lat: float, max_m: float, radius: float = EARTH_RADIUS_M) -> list[tuple[float, float, float, float]]:
    """(west, south, east, north) of one box that holds a search circle, or of two at the date line."""
    slack = 1 + 1e-9
    angle = max_m / radius
    band = math.degrees(angle) * slack
    south, north = lat - band, lat + band
    if south <= -90 or north >= 90:
        return [(-180.0, max(south, -90.0), 180.0, min(north, 90.0))]
    half = math.degrees(math.asin(min(1.0, math.sin(angle) / math.cos(math.radians(lat))))) * slack
    middle = (lon + 180) % 360 - 180
    west, east = middle - half, middle + half
    if west < -180:
        return [(-180.0, south, east, north), (west + 360, south, 180.0, north)]
    if east > 180:
        return [(-180.0, south, east - 360, north), (west, south, 180.0, north)]
    return [(west, south, east, north)]
