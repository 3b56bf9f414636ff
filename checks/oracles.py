"""SQL equivalents of the queries, written independently of the Spark code.

Nothing here comes from the package: cells are found by halving intervals, the
projection uses another series with constants of its own.  Words are cleaned
token by token, containment is tested by the side of each
corner, and every spatial question compares all pairs.
"""

import math

from checks.inputs import AREA_SCALE, CORNERS, METRO_SCALE, METRO_SHIFT, SOURCES, TAG_KEYS
from checks.queries import CITY, EXCLUDED, STOP_WORDS


def _list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


# --- text -------------------------------------------------------------------

def _words(rows: str, keys: str = "", text: str = "text", stop: str | None = _list(STOP_WORDS)) -> str:
    """SELECT of ``keys`` and word, one row per occurrence in the text of ``rows``."""
    comma = f"{keys}, " if keys else ""
    without = f" AND word NOT IN ({stop})" if stop else ""
    return rf"""
      SELECT {comma}word FROM (
        SELECT {comma}regexp_replace(
            regexp_replace(t, '[#.!?,"(){{}}\[\]|]|&amp;', '', 'g'),
            '^[@\\/~]*|[\\/:~]*$', '', 'g') AS word
        FROM (SELECT {comma}unnest(regexp_split_to_array(
                regexp_replace(lower({text}), '[^\x00-\x7F]', '', 'g'), '[ \t\n\r\x0B\f]+')) AS t
              FROM {rows})
        WHERE t <> '' AND NOT starts_with(t, 'http'))
      WHERE length(word) > 1{without}"""


DOC_WORDS = _words("documents", "lang, source")
LANG_COUNTS = f"""SELECT lang AS metro_area, word, count(*) AS count
    FROM ({DOC_WORDS}) GROUP BY ALL HAVING count(*) >= 2"""
TURN_WORDS = _words("conversations", "role")
ROLE_COUNTS = f"SELECT role, word, count(*) AS count FROM ({TURN_WORDS}) GROUP BY ALL"
ROLLUP = f"""SELECT word, lang AS state, source AS county, count(*) AS count FROM ({DOC_WORDS})
    GROUP BY GROUPING SETS ((word), (word, lang), (word, lang, source)) HAVING count(*) >= 5"""


# --- derived points, nodes and outlines ---------------------------------------

def _lon(key: str) -> str:
    return f"(-125e0 + ((({key} % 500) * 7919) % 58000) / 1e3 + ({key} % 11) * 3e-4)"


def _lat(key: str) -> str:
    return f"(25e0 + ((({key} % 500) * 104729) % 24500) / 1e3 + ({key} % 7) * 3e-4)"


POINTS = f"SELECT event_id, event_type, user_id, {_lon('event_id')} AS lon, {_lat('event_id')} AS lat FROM events"
SOURCE = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SOURCES.items()) + " END"
EVENT_POSTS = f"""SELECT CAST(event_id AS VARCHAR) AS tweet_id, user_id, {SOURCE} AS source,
    {_lon('event_id')} AS lon, {_lat('event_id')} AS lat FROM events"""
TEXT_POSTS = f"""
    SELECT CASE WHEN doc_id % 9 <> 0 THEN source END AS description, text,
           {_lon('doc_id')} AS lon, {_lat('doc_id')} AS lat FROM documents
    UNION ALL
    SELECT role, text, {_lon('(conv_id * 31 + turn)')}, {_lat('(conv_id * 31 + turn)')} FROM conversations"""
KEPT_POSTS = f"""SELECT * FROM ({TEXT_POSTS})
    WHERE NOT regexp_matches(coalesce(description, ''), '{"|".join(EXCLUDED)}')"""
TAG = "CASE p_partkey % 6 " + " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(TAG_KEYS)) + " END"
NODES = f"""SELECT p_partkey AS id, {TAG} AS tag, CASE WHEN p_partkey % 7 <> 0 THEN p_name END AS name,
    {_lon('p_partkey')} AS lon, {_lat('p_partkey')} AS lat FROM part"""
POIS = f"SELECT * FROM ({NODES}) WHERE tag <> 'building'"


def _outline(fid: str, rows: str, scale: int, properties: str) -> str:
    corners = ", ".join(
        f"cx + {dx / scale!r} AS x{i}, cy + {dy / scale!r} AS y{i}" for i, (dx, dy) in enumerate(CORNERS)
    )
    return f"SELECT CAST({fid} AS BIGINT) AS fid, {properties}, {corners} FROM ({rows})"


def _nations(shift: int = 0) -> str:
    return f"""SELECT *, {-2_000_000 + shift}e0 + (n_nationkey % 5) * 1e6 AS cx,
        -1200000e0 + (n_nationkey // 5) * 6e5 AS cy FROM nation"""


ZONES = _outline("n_nationkey", _nations(), 1, "CAST(n_regionkey AS VARCHAR) AS state, n_name AS county")
METROS = (
    _outline("n_nationkey", _nations(), METRO_SCALE, "n_name || ' A' AS metro_area")
    + " UNION ALL "
    + _outline("n_nationkey + 100", _nations(METRO_SHIFT), METRO_SCALE, "n_name || ' B' AS metro_area")
)
AREAS = _outline(
    "c_custkey",
    """SELECT *, -2000000e0 + ((c_custkey * 7919) % 4000) * 1e3 AS cx,
       -1200000e0 + ((c_custkey * 104729) % 2400) * 1e3 AS cy FROM customer""",
    AREA_SCALE, "c_name AS name",
)
SIDES = tuple((i, (i + 1) % 4) for i in range(4))
INSIDE = " AND ".join(f"(x{b} - x{a}) * (y - y{a}) - (x - x{a}) * (y{b} - y{a}) >= 0" for a, b in SIDES)


def _side_distance(a: int, b: int) -> str:
    dx, dy = f"(x{b} - x{a})", f"(y{b} - y{a})"
    t = f"greatest(0e0, least(1e0, ((x - x{a}) * {dx} + (y - y{a}) * {dy}) / ({dx} * {dx} + {dy} * {dy})))"
    return f"sqrt(power(x - x{a} - {t} * {dx}, 2) + power(y - y{a} - {t} * {dy}, 2))"


DISTANCE = f"CASE WHEN {INSIDE} THEN 0e0 ELSE least({', '.join(_side_distance(a, b) for a, b in SIDES)}) END"


# --- cells and projection -----------------------------------------------------

ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"
# Lowest coordinate and extent of the axes, and bits of each at a precision.
LON, LAT = (-180, 360), (-90, 180)
BITS = {7: (18, 17), 8: (20, 20)}
HALVINGS = 20


def _index(coordinate: str, axis, bits: int) -> str:
    low, extent = axis
    return (
        f"CAST(greatest(least(ceil(({coordinate} - ({low}::DOUBLE)) / {extent}::DOUBLE * {float(1 << bits)}::DOUBLE) - 1, "
        f"{(1 << bits) - 1}), 0) AS BIGINT)"
    )


def _snap(coordinate: str, axis, bits: int, digits: int | None) -> str:
    low, extent = axis
    center = f"(({_index(coordinate, axis, bits)} + 0.5::DOUBLE) * {extent / (1 << bits)!r}::DOUBLE + ({low}::DOUBLE))"
    return center if digits is None else f"round({center}, {digits})"


def _snapped(precision: int, rounded: bool = True) -> tuple[str, str]:
    lon_bits, lat_bits = BITS[precision]
    digits = {7: 2, 8: 3}[precision] if rounded else None
    return _snap("lon", LON, lon_bits, digits), _snap("lat", LAT, lat_bits, digits)


def _halved(rows: str) -> str:
    """Rows with ``lon_i`` and ``lat_i``: the halves chosen in 20 halvings of each axis, as bits."""
    sql = f"SELECT *, -180e0 AS lon_lo, 180e0 AS lon_hi, -90e0 AS lat_lo, 90e0 AS lat_hi, 0 AS lon_i, 0 AS lat_i FROM ({rows})"
    for _ in range(HALVINGS):
        new = ", ".join(
            f"CASE WHEN {x} > ({x}_lo + {x}_hi) / 2 THEN ({x}_lo + {x}_hi) / 2 ELSE {x}_lo END AS {x}_lo, "
            f"CASE WHEN {x} > ({x}_lo + {x}_hi) / 2 THEN {x}_hi ELSE ({x}_lo + {x}_hi) / 2 END AS {x}_hi, "
            f"2 * {x}_i + CASE WHEN {x} > ({x}_lo + {x}_hi) / 2 THEN 1 ELSE 0 END AS {x}_i"
            for x in ("lon", "lat")
        )
        sql = f"SELECT * REPLACE ({new}) FROM ({sql})"
    return sql


def _letters(n: int) -> str:
    """The first ``n`` characters of the cell of halved rows: bits of longitude and latitude in turn, five each."""
    out = []
    for k in range(n):
        value = " + ".join(
            f"(({'lon_i' if bit % 2 == 0 else 'lat_i'} >> {HALVINGS - 1 - bit // 2}) & 1) * {16 >> (bit - 5 * k)}"
            for bit in range(5 * k, 5 * k + 5)
        )
        out.append(f"substr('{ALPHABET}', CAST({value} + 1 AS BIGINT), 1)")
    return " || ".join(out)


# Equidistant conic on GRS80 with parallels 33 and 45 and origin 39 N, 96 W.  Meridian arcs by the series in the third
# flattening n (Helmert), in metres: factor of the latitude, then of sin(2 k latitude).
_A, _ECC2 = 6378137.0, 0.00669438002290079
_N = (1 - math.sqrt(1 - _ECC2)) / (1 + math.sqrt(1 - _ECC2))
_HELMERT = [
    _A / (1 + _N) * c
    for c in (1 + _N**2 / 4 + _N**4 / 64, -3 / 2 * (_N - _N**3 / 8), 15 / 16 * (_N**2 - _N**4 / 4), -35 / 48 * _N**3, 315 / 512 * _N**4)
]


def _arc_m(degrees: float) -> float:
    phi = math.radians(degrees)
    return _HELMERT[0] * phi + sum(c * math.sin(2 * k * phi) for k, c in enumerate(_HELMERT[1:], start=1))


def _circle_m(degrees: float) -> float:
    phi = math.radians(degrees)
    return _A * math.cos(phi) / math.sqrt(1 - _ECC2 * math.sin(phi) ** 2)


_CONE = (_circle_m(33) - _circle_m(45)) / (_arc_m(45) - _arc_m(33))
_APEX = _circle_m(33) / _CONE + _arc_m(33)
_ORIGIN = _APEX - _arc_m(39)


def _project(lon: str, lat: str) -> tuple[str, str]:
    phi = f"radians({lat})"
    arc = f"({_HELMERT[0]!r}::DOUBLE * {phi}" + "".join(
        f" + ({c!r}::DOUBLE) * sin({2 * k} * {phi})" for k, c in enumerate(_HELMERT[1:], start=1)
    ) + ")"
    radius = f"({_APEX!r}::DOUBLE - {arc})"
    angle = f"({_CONE!r}::DOUBLE * radians({lon} + 96::DOUBLE))"
    return f"{radius} * sin({angle})", f"{_ORIGIN!r}::DOUBLE - {radius} * cos({angle})"


def _looked_up(rows: str, columns: str, snap: str = "rounded", precision: int = 7) -> str:
    """Rows with the projected point at which they are looked up, as x and y."""
    lon, lat = ("lon", "lat") if snap == "exact" else _snapped(precision, rounded=snap == "rounded")
    x, y = _project("at_lon", "at_lat")
    return f"SELECT *, {x} AS x, {y} AS y FROM (SELECT {columns}, {lon} AS at_lon, {lat} AS at_lat FROM ({rows}))"


def _in_county(rows: str, columns: str, how: str = "JOIN", snap: str = "rounded", precision: int = 7) -> str:
    """Rows with the state and county whose outline holds their lookup point."""
    points = _looked_up(rows, columns, snap, precision)
    return f"""
      WITH p AS ({points}),
      c AS (SELECT at_lon, at_lat, arg_min(state, fid) AS state, arg_min(county, fid) AS county
            FROM (SELECT DISTINCT at_lon, at_lat, x, y FROM p), ({ZONES}) WHERE {INSIDE} GROUP BY ALL)
      SELECT p.* EXCLUDE (x, y), state, county FROM p {how} c USING (at_lon, at_lat)"""


def _normals(sides: int) -> list[tuple[float, float]]:
    """Outward normals of a regular polygon whose first corner is on the positive x axis."""
    return [(math.cos(math.pi * (2 * k + 1) / sides), math.sin(math.pi * (2 * k + 1) / sides)) for k in range(sides)]


def _in_polygon(dx: str, dy: str, radius: float, sides: int) -> str:
    """An offset is on the inner side of every side."""
    limit = radius * math.cos(math.pi / sides)
    return " AND ".join(f"({dx}) * {c!r} + ({dy}) * {s!r} <= {limit!r}" for c, s in _normals(sides))


def _meets_polygon(radius: float, sides: int) -> str:
    """Two convex outlines meet unless a line along a side of one of them keeps them apart."""
    limit = radius * math.cos(math.pi / sides)
    beyond = [
        f"least({', '.join(f'(x{i} - x) * {c!r} + (y{i} - y) * {s!r}' for i in range(4))}) <= {limit!r}" for c, s in _normals(sides)
    ]
    corners = [(radius * math.cos(2 * math.pi * k / sides), radius * math.sin(2 * math.pi * k / sides)) for k in range(sides)]
    outside = [
        "greatest(" + ", ".join(
            f"(x{b} - x{a}) * (y + {v!r} - y{a}) - (x + {u!r} - x{a}) * (y{b} - y{a})" for u, v in corners
        ) + ") >= 0"
        for a, b in SIDES
    ]
    return " AND ".join(beyond + outside)


def _in_metro(rows: str, columns: str, snap: str = "rounded", meets: str = "TRUE") -> str:
    """Rows with the nearest metro area within 80,450 m of their lookup point."""
    points = _looked_up(rows, columns, snap)
    return f"""
      WITH p AS ({points}),
      d AS (SELECT at_lon, at_lat, fid, metro_area, {DISTANCE} AS dist
            FROM (SELECT DISTINCT at_lon, at_lat, x, y FROM p), ({METROS}) WHERE {meets}),
      c AS (SELECT at_lon, at_lat, metro_area FROM d WHERE dist <= 80450
            QUALIFY row_number() OVER (PARTITION BY at_lon, at_lat ORDER BY dist, fid) = 1)
      SELECT p.* EXCLUDE (x, y), metro_area FROM p JOIN c USING (at_lon, at_lat)"""


def _haversine(lon: float, lat: float) -> str:
    return (
        f"2 * 6378100e0 * asin(least(1e0, sqrt(power(sin(radians(lat - {lat}) / 2), 2) + "
        f"cos(radians({lat})) * cos(radians(lat)) * power(sin(radians(lon - ({lon})) / 2), 2))))"
    )


# There and back again is where one started.
UNPROJECT = f"SELECT event_id, round(lon, 5) AS lon_back, round(lat, 5) AS lat_back FROM ({POINTS})"

_lon7, _lat7 = _snapped(7)
_lon8, _lat8 = _snapped(8)
_lon_c, _lat_c = _snapped(7, rounded=False)
_city_x, _city_y = _project(f"({CITY[0]})", f"({CITY[1]})")
_px, _py = _project("lon", "lat")
_sx, _sy = _project("cell_lon", "cell_lat")
SPOTS = f"SELECT {_lon8} AS cell_lon, {_lat8} AS cell_lat, count(*) AS n FROM ({POINTS}) GROUP BY ALL"


def _pairs_within(meets: str = "TRUE") -> str:
    return f"""
        SELECT cell_lon, cell_lat, n, id, round(dist, 1) AS dist FROM (
          SELECT *, sqrt(power(s.x - o.x, 2) + power(s.y - o.y, 2)) AS dist
          FROM (SELECT *, {_sx} AS x, {_sy} AS y FROM ({SPOTS})) s
          JOIN (SELECT id, {_px} AS x, {_py} AS y FROM ({NODES})) o ON abs(s.y - o.y) <= 101 AND {meets})
        WHERE dist <= 100"""


def _metro_words(snap: str) -> str:
    return f"""
        SELECT metro_area, word, count(*) AS count
        FROM ({_words(f"({_in_metro(KEPT_POSTS, 'text', snap)})", 'metro_area')})
        GROUP BY ALL HAVING count(*) >= 2"""


NEAR_POINTS = f"""SELECT event_id, round(d, 1) AS distance_m
    FROM (SELECT event_id, {_haversine(*CITY)} AS d FROM ({POINTS})) WHERE d <= 400000"""
STATUS_TIME = """CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 13 = 0 THEN 'soon'
    ELSE CAST(epoch_us(ts) // 1000 AS VARCHAR) END"""
STATUS_SLOT = """CASE WHEN event_id % 11 = 0 OR event_id % 13 = 0 THEN 'unknown'
    ELSE strftime(date_trunc('day', ts), '%Y-%m-%d_%H-%M') END"""

ORACLES = {
    "word_extract_count": f"""
        WITH stop AS (SELECT DISTINCT word FROM ({_words('benchmark', stop=None)}))
        SELECT word, count(*) AS count FROM ({_words('documents', stop=None)})
        WHERE word NOT IN (SELECT word FROM stop) GROUP BY word""",
    "turn_words": ROLE_COUNTS,
    "page_words": f"SELECT word, count(*) AS count FROM ({_words('pages', text='html', stop=None)}) GROUP BY word",
    "exclude_terms": f"""SELECT description, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars
        FROM ({KEPT_POSTS}) GROUP BY description""",
    "allow_domains": r"SELECT page_id, url FROM pages WHERE regexp_matches(url, 'example\.com|example\.org')",
    "allow_sources": rf"""SELECT tweet_id, source FROM ({EVENT_POSTS})
        WHERE regexp_matches(source, 'twitter\.com|foursquare\.com|instagram\.com|untappd\.com')""",
    "bbox_filter": f"""SELECT tweet_id, user_id FROM ({EVENT_POSTS})
        WHERE lon >= -110.5 AND lon <= -85.125 AND lat >= 30.25 AND lat <= 42""",
    "valid_posts": f"""SELECT CAST(event_id AS VARCHAR) AS tweet_id, user_id, event_type AS name,
        'u' || user_id AS screen_name, props AS description, 'place ' || (user_id % 7) AS location,
        CAST(user_id % 97 AS INTEGER) AS friends_count, CAST(user_id % 89 AS INTEGER) AS followers_count,
        props AS text, event_type AS source, CAST(CAST(ts AS DATE) AS VARCHAR) AS created_at, {STATUS_TIME} AS timestamp,
        round({_lon('event_id')}, 4) AS lon, round({_lat('event_id')}, 4) AS lat
        FROM events WHERE event_type NOT IN ('error', 'signup')""",
    "word_rollup": ROLLUP,
    "group_word_count": LANG_COUNTS,
    "top_words": f"SELECT * FROM ({LANG_COUNTS}) WHERE metro_area = 'en' ORDER BY count DESC, word LIMIT 25",
    "all_words_of_group": f"SELECT * FROM ({LANG_COUNTS}) WHERE metro_area = 'de'",
    "distinct_groups": f"SELECT DISTINCT metro_area FROM ({LANG_COUNTS})",
    "find_where": f"SELECT * FROM ({LANG_COUNTS}) WHERE count >= 10 AND metro_area <> 'fr'",
    "find_limited": f"""SELECT * FROM ({LANG_COUNTS}) WHERE count > 20
        ORDER BY count DESC, metro_area, word LIMIT 40""",
    "group_documents": f"""
        WITH r AS ({LANG_COUNTS}),
        b AS (SELECT metro_area, CAST(ceil(count(*) / 500) AS BIGINT) AS batches FROM r GROUP BY 1)
        SELECT metro_area, CAST('0x' || substr(md5(word), 1, 8) AS BIGINT) % batches AS batch,
               CAST(count(*) AS INTEGER) AS n, string_agg(word || '=' || count, ' ' ORDER BY word) AS documents
        FROM r JOIN b USING (metro_area) GROUP BY 1, 2""",
    "geohash_cells": f"""SELECT event_id, {_letters(4)} AS cell4, {_letters(7)} AS cell7, {_letters(8)} AS cell8
        FROM ({_halved(POINTS)})""",
    "snap_points": f"""
        SELECT event_id, round(lon_c, 2) AS lon7, round(lat_c, 2) AS lat7, round((lon_lo + lon_hi) / 2, 3) AS lon8,
          round((lat_lo + lat_hi) / 2, 3) AS lat8, round(lon_c, 6) AS lon_c, round(lat_c, 6) AS lat_c
        FROM (SELECT *, -180 + ((lon_i >> 2) + 0.5::DOUBLE) * (360::DOUBLE / 262144) AS lon_c,
                -90 + ((lat_i >> 3) + 0.5::DOUBLE) * (180::DOUBLE / 131072) AS lat_c FROM ({_halved(POINTS)}))""",
    "project_points": f"SELECT event_id, round({_px}, 1) AS x, round({_py}, 1) AS y FROM ({POINTS})",
    "unproject_points": UNPROJECT,
    "cell_reuse": f"""SELECT count(*) - count(DISTINCT cell) AS hits, count(DISTINCT cell) AS misses
        FROM (SELECT {_letters(7)} AS cell FROM ({_halved(POINTS)}))""",
    "county_join": f"SELECT event_id, state, county FROM ({_in_county(POINTS, 'event_id')})",
    "county_join_exact": f"""SELECT event_id, state, county
        FROM ({_in_county(POINTS, 'event_id', 'LEFT JOIN', snap='exact')})""",
    "nearest_metro": f"SELECT event_id, metro_area FROM ({_in_metro(POINTS, 'event_id')})",
    "nearest_metro_shuffled": f"""SELECT metro_area, event_type, count(*) AS n
        FROM ({_in_metro(POINTS, 'event_type')}) GROUP BY ALL""",
    "poi_within": _pairs_within(),
    "poi_within_cut": _pairs_within(),
    "poi_within_polygon": _pairs_within(_in_polygon("o.x - s.x", "o.y - s.y", 100, 8)),
    "nearest_metro_polygon": f"""SELECT event_id, metro_area
        FROM ({_in_metro(POINTS, 'event_id', meets=_meets_polygon(80450, 8))})""",
    "state_county_words": f"""
        SELECT word, state, county, count(*) AS count
        FROM ({_words(f"({_in_county(KEPT_POSTS, 'text')})", 'state, county')})
        GROUP BY GROUPING SETS ((word), (word, state), (word, state, county)) HAVING count(*) >= 5""",
    "metro_words": _metro_words("rounded"),
    "metro_words_shuffled": _metro_words("center"),
    "poi_nearby": f"""
        WITH t AS ({_in_metro(EVENT_POSTS, 'tweet_id, source, lon, lat')}),
        tweets AS (SELECT tweet_id, metro_area, {_lon8} AS cell_lon, {_lat8} AS cell_lat FROM t
                   WHERE regexp_matches(source, 'twitter|foursquare|instagram|untappd')),
        o AS ({_in_metro(POIS, 'name, lon, lat')}),
        places AS (SELECT metro_area, name, {_px} AS ox, {_py} AS oy FROM o WHERE name IS NOT NULL),
        near AS (SELECT DISTINCT tweet_id, metro_area, name
                 FROM (SELECT *, {_sx} AS x, {_sy} AS y FROM tweets) JOIN places USING (metro_area)
                 WHERE sqrt(power(x - ox, 2) + power(y - oy, 2)) <= 100)
        SELECT metro_area, name AS poi, count(*) AS count FROM near GROUP BY ALL""",
    "poi_nodes": f"""SELECT CASE WHEN name IS NULL THEN tag WHEN tag < 'name' THEN tag || ',name' ELSE 'name,' || tag END AS keys,
        count(*) AS n, CAST(sum(CAST(round(lon * 10000) AS BIGINT)) AS BIGINT) AS lon_sum
        FROM ({POIS}) GROUP BY 1""",
    "named_pois": f"SELECT name, round(lon, 4) AS lon, round(lat, 4) AS lat FROM ({POIS}) WHERE name IS NOT NULL",
    "mixed_split": f"""SELECT kind, count(*) AS n, CAST(sum(CAST(round(lat * 10000) AS BIGINT)) AS BIGINT) AS lat_sum
        FROM (SELECT CASE WHEN source IS NULL THEN 'rejected' ELSE 'post' END AS kind, lat FROM ({EVENT_POSTS})
              UNION ALL SELECT 'poi', lat FROM ({NODES})) GROUP BY 1""",
    "metro_sort": f"""SELECT metro_area, type_tag, record FROM ({_in_metro(
        f"SELECT 1 AS type_tag, id AS record, lon, lat FROM ({NODES}) UNION ALL "
        f"SELECT 2, event_id, lon, lat FROM ({POINTS})", 'type_tag, record')})""",
    "near_points": NEAR_POINTS,
    "near_by_cell": NEAR_POINTS,
    "nearest_by_cell": f"""SELECT event_id, round(d, 1) AS distance_m
        FROM (SELECT event_id, {_haversine(*CITY)} AS d FROM ({POINTS})) ORDER BY d, event_id LIMIT 300""",
    "near_areas": f"""SELECT fid, round(d, 2) AS distance_m FROM (SELECT fid, {DISTANCE} AS d
        FROM (SELECT *, {_city_x} AS x, {_city_y} AS y FROM ({AREAS}))) WHERE d <= 150000""",
    "intersecting_areas": f"""SELECT fid, name
        FROM (SELECT *, {_city_x} AS x, {_city_y} AS y FROM ({AREAS})) WHERE {INSIDE}""",
    "insert_ignore": f"""
        WITH old AS (SELECT word, CAST(sum(count) AS BIGINT) AS count FROM ({LANG_COUNTS}) GROUP BY word)
        SELECT * FROM old UNION ALL
        SELECT word, min(count) FROM ({ROLE_COUNTS}) WHERE word NOT IN (SELECT word FROM old) GROUP BY word""",
    "tsv_roundtrip": f"""SELECT word || chr(9) || coalesce(state, 'None') || chr(9) || coalesce(county, 'None')
        || chr(9) || count AS value FROM ({ROLLUP})""",
    "result_sink_roundtrip": f"""SELECT * FROM ({LANG_COUNTS}) UNION ALL
        SELECT role, word, count FROM ({ROLE_COUNTS}) WHERE count >= 2""",
    "stopword_roundtrip": f"SELECT DISTINCT word FROM ({_words('conversations', stop=None)})",
    "feature_roundtrip": f"""SELECT fid AS custkey, name, CAST(4 AS INTEGER) AS n_edges,
        least(x0, x1, x2, x3) AS minx, least(y0, y1, y2, y3) AS miny,
        greatest(x0, x1, x2, x3) AS maxx, greatest(y0, y1, y2, y3) AS maxy FROM ({AREAS})""",
    "stream_to_log": f"""SELECT CAST(event_id AS VARCHAR) AS tweet_id, user_id, {STATUS_SLOT} AS slot,
        {STATUS_TIME} AS timestamp FROM events
        WHERE event_type NOT IN ('error', 'signup')
          AND {_lon('event_id')} BETWEEN -120 AND -80 AND {_lat('event_id')} BETWEEN 26 AND 45""",
    # Days that end three days or more before the latest post; the closing query sees the late posts last.
    "stream_then_ingest": f"""WITH p AS (
          SELECT event_id, user_id, {STATUS_TIME} AS timestamp, {STATUS_SLOT} AS slot, event_id % 50 = 0 AS late FROM events
          WHERE event_type NOT IN ('error', 'signup')
            AND {_lon('event_id')} BETWEEN -120 AND -80 AND {_lat('event_id')} BETWEEN 26 AND 45
        ), t AS (SELECT *, TRY_CAST(timestamp AS BIGINT) AS ms FROM p WHERE slot <> 'unknown'),
        m AS (SELECT max(ms) - 3 * 86400000 AS mark FROM t),
        c AS (SELECT max(slot) AS last FROM t, m WHERE NOT late AND ms // 86400000 * 86400000 + 86400000 <= mark)
        SELECT CAST(event_id AS VARCHAR) AS tweet_id, user_id, timestamp FROM p, c WHERE slot = 'unknown' OR slot <= last""",
    "ingest_archived": f"""SELECT tweet_id, user_id, source, round(lon, 4) AS lon, round(lat, 4) AS lat
        FROM ({EVENT_POSTS})""",
}
ORACLES["county_join_fine"] = f"""SELECT event_id, state, county FROM ({_in_county(POINTS, 'event_id', precision=8, snap='center')})"""
ORACLES["word_extract_count_shuffled"] = ORACLES["word_extract_count"]
ORACLES["metro_words_from_logs"] = f"""SELECT metro_area || chr(9) || count || chr(9) || word AS value
    FROM ({ORACLES['metro_words']})"""
ORACLES["poi_nearby_from_logs"] = f"""SELECT metro_area || chr(9) || count || chr(9) || poi AS value
    FROM ({ORACLES['poi_nearby']})"""
ORACLES["feature_lines_roundtrip"] = f"""SELECT row_number() OVER (ORDER BY custkey) - 1 AS fid, * FROM ({ORACLES['feature_roundtrip']})"""
ORACLES["feature_split_roundtrip"] = ORACLES["feature_roundtrip"]
ORACLES["state_county_words_shuffled"] = ORACLES["state_county_words"]
ORACLES["poi_nearby_shuffled"] = ORACLES["poi_nearby"]
ORACLES["metro_words_incremental"] = ORACLES["metro_words"]
ORACLES["state_county_words_incremental"] = ORACLES["state_county_words"]
ORACLES["nearest_metro_known"] = f"""
    WITH points AS (SELECT count(*) AS records, count(DISTINCT (at_lon, at_lat)) AS places FROM ({_looked_up(POINTS, 'event_id')})),
    found AS (SELECT metro_area, count(*) AS n FROM ({_in_metro(POINTS, 'event_id')}) GROUP BY ALL)
    SELECT found.*, records - places AS first_hits, places AS first_misses, records AS second_hits, CAST(0 AS BIGINT) AS second_misses
    FROM found, points"""
