"""Planar geometry on edge lists.

A geometry is an array of segments ``struct<x1,y1,x2,y2>`` plus a flag that says
whether the segments enclose an area.  Holes and the parts of a multipolygon
need no special care: a point is inside when a ray from it crosses an odd
number of segments.  A lone point is a segment of length zero.
"""

import math

_SEGMENT = "named_struct('x1', get({a}, 0), 'y1', get({a}, 1), 'x2', get({b}, 0), 'y2', get({b}, 1))"
# Positive when the point lies left of the directed segment e.
_TURN = "((e.x2 - e.x1) * ({y} - e.y1) - ({x} - e.x1) * (e.y2 - e.y1))"


def line_edges(points: str) -> str:
    """Segments between neighbouring ``[x, y]`` points."""
    n = f"greatest(size({points}) - 1, 0)"
    segment = _SEGMENT.format(a="a", b="b")
    return f"zip_with(slice({points}, 1, {n}), slice({points}, 2, {n}), (a, b) -> {segment})"


def ring_edges(points: str) -> str:
    """Segments of a closed ring; an unclosed ring gets its closing segment."""
    closing = f"get({points}, 0) = get({points}, size({points}) - 1)"
    closed = f"if({closing}, {points}, concat({points}, array(get({points}, 0))))"
    return line_edges(closed)


def point_edges(point: str) -> str:
    return f"array({_SEGMENT.format(a=point, b=point)})"


def envelope(edges: str) -> dict[str, str]:
    """Bounds of the edges; null for an empty geometry."""
    return {
        f"{end}{axis}": f"array_{end}(transform({edges}, e -> {pick}(e.{axis}1, e.{axis}2)))"
        for end, pick in (("min", "least"), ("max", "greatest"))
        for axis in ("x", "y")
    }


def inside(x: str, y: str, edges: str) -> str:
    """Odd number of crossings of the ray from the point towards larger x."""
    turn = _TURN.format(x=x, y=y)
    crossing = f"(e.y1 > {y}) != (e.y2 > {y}) and ({turn} > 0) = (e.y2 > e.y1)"
    return f"aggregate({edges}, 0, (n, e) -> if({crossing}, n + 1, n)) % 2 = 1"


def _left(x: str, y: str) -> str:
    """The point lies left of the directed segment e; one on its line counts as if it were a little higher."""
    turn = _TURN.format(x=x, y=y)
    return f"({turn} > 0 or ({turn} = 0 and e.x2 > e.x1))"


def corner_parity(x: str, y: str, edges: str) -> str:
    """1 if the ray from a corner towards larger x crosses an odd number of segments, else 0."""
    crossing = f"(e.y1 > {y}) != (e.y2 > {y}) and {_left(x, y)} = (e.y2 > e.y1)"
    return f"aggregate({edges}, 0, (n, e) -> if({crossing}, n + 1, n)) % 2"


def inside_from(x: str, y: str, edges: str, corner_x: str, corner_y: str, parity: str) -> str:
    """Whether the point is inside, from the parity of a corner and the segments between the two.

    The way goes along the point's own height to the corner's x and from there to
    the corner.  Each segment that it crosses changes the side.
    """
    along = f"(e.y1 > {y}) != (e.y2 > {y}) and {_left(x, y)} != {_left(corner_x, y)}"
    down = f"(e.x1 > {corner_x}) != (e.x2 > {corner_x}) and {_left(corner_x, y)} != {_left(corner_x, corner_y)}"
    crossed = f"aggregate({edges}, {parity}, (n, e) -> n + if({along}, 1, 0) + if({down}, 1, 0))"
    return f"{crossed} % 2 = 1"


def near_box(x: str, y: str, half: str) -> str:
    """Whether the segment e can touch the square around (x, y): its line does, and so does its envelope."""
    dx, dy = "(e.x2 - e.x1)", "(e.y2 - e.y1)"
    turn = _TURN.format(x=x, y=y)
    return (
        f"greatest(e.x1, e.x2) >= {x} - {half} and least(e.x1, e.x2) <= {x} + {half}"
        f" and greatest(e.y1, e.y2) >= {y} - {half} and least(e.y1, e.y2) <= {y} + {half}"
        f" and abs({turn}) <= {half} * (abs({dx}) + abs({dy}))"
    )


def on_edge(x: str, y: str, edges: str) -> str:
    turn = _TURN.format(x=x, y=y)
    in_box = (
        f"{x} between least(e.x1, e.x2) and greatest(e.x1, e.x2)"
        f" and {y} between least(e.y1, e.y2) and greatest(e.y1, e.y2)"
    )
    return f"exists({edges}, e -> {turn} = 0 and {in_box})"


def covers(x: str, y: str, edges: str, areal: str, within: str | None = None) -> str:
    """True for a point inside the geometry or on its boundary; ``within`` is another test of the inside."""
    return f"(({areal} and {within or inside(x, y, edges)}) or {on_edge(x, y, edges)})"


def edge_distance(x: str, y: str, edges: str) -> str:
    """Distance to the nearest segment; null for an empty geometry."""
    dx, dy = "(e.x2 - e.x1)", "(e.y2 - e.y1)"
    length = f"({dx} * {dx} + {dy} * {dy})"
    along = f"(({x} - e.x1) * {dx} + ({y} - e.y1) * {dy}) / if({length} > 0, {length}, 1D)"
    share = f"greatest(least({along}, 1D), 0D)"
    offsets = f"named_struct('u', {x} - e.x1 - {share} * {dx}, 'v', {y} - e.y1 - {share} * {dy})"
    squares = f"transform(transform({edges}, e -> {offsets}), o -> o.u * o.u + o.v * o.v)"
    return f"sqrt(array_min({squares}))"


def distance(x: str, y: str, edges: str, areal: str, within: str | None = None) -> str:
    """0 inside an area, else the distance to the nearest segment; ``within`` is another test of the inside."""
    return f"if({areal} and {within or inside(x, y, edges)}, 0D, {edge_distance(x, y, edges)})"


def box_distance(x: str, y: str) -> str:
    """Distance to the envelope ``minx, miny, maxx, maxy``, 0 inside: no point of the geometry is nearer."""
    return f"hypot(greatest(minx - {x}, {x} - maxx, 0D), greatest(miny - {y}, {y} - maxy, 0D))"


def _step(sides: int) -> float:
    if sides < 8 or sides % 4:
        raise ValueError(f"sides must be a multiple of 4 and 8 at least, not {sides}")
    return 2 * math.pi / sides


def inner_radius(radius: float, sides: int) -> float:
    """What is nearer than this to the middle of a polygonal circle lies in it."""
    return radius * math.cos(_step(sides) / 2)


def in_polygonal_circle(dx: str, dy: str, radius: float, sides: int) -> str:
    """Whether an offset lies in the regular polygon with corners on the circle, the first on the positive x axis."""
    step = _step(sides)
    off_middle = f"pmod(atan2({dy}, {dx}), {step!r}D) - {step / 2!r}D"
    return f"hypot({dx}, {dy}) * cos({off_middle}) <= {inner_radius(radius, sides)!r}D"


def meets_polygonal_circle(x: str, y: str, edges: str, radius: float, sides: int) -> str:
    """Whether a segment meets the polygonal circle around (x, y): what all its sides leave of the segment is not empty."""
    step, inner = _step(sides), f"{inner_radius(radius, sides)!r}D"
    across, up = (f"{name}((k + 0.5D) * {step!r}D)" for name in ("cos", "sin"))
    # how far the ends of the segment lie beyond side k
    ends = [f"(({across}) * (e.x{i} - {x}) + ({up}) * (e.y{i} - {y}) - {inner})" for i in (1, 2)]
    a, b = ends
    cut = f"({a} / ({a} - {b}))"
    low = f"if({a} > 0 and {b} <= 0, greatest(s.low, {cut}), if({a} > 0, 2D, s.low))"
    high = f"if({b} > 0 and {a} <= 0, least(s.high, {cut}), s.high)"
    left = (
        f"aggregate(sequence(0, {sides - 1}), named_struct('low', 0D, 'high', 1D),"
        f" (s, k) -> named_struct('low', {low}, 'high', {high}), s -> s.low <= s.high)"
    )
    return f"exists({edges}, e -> {left})"
