"""Word counts by county and by metro area, and points of interest near posts.

``known`` is a folder where the answers of lookups are kept for later runs.
``sides`` puts polygons of so many sides in the place of search circles (64 is
what a buffer of 16 segments a quadrant gives).
"""

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placetally.operators import filters
from placetally.operators.counts import (
    COUNTY_MIN_COUNT,
    METRO_MIN_COUNT,
    metro_word_count,
    poi_tweet_count,
    word_counts,
    word_rollup,
)
from placetally.operators.skew import ROWS_PER_TASK
from placetally.operators.spatial import (
    AREA_PRECISION,
    BROADCAST_BYTES,
    CELL_KEYS,
    COUNTY_PROPS,
    COUNTY_TILE_M,
    METRO_DISTANCE_M,
    METRO_PROPS,
    METRO_TILE_M,
    POI_DISTANCE_M,
    POI_PRECISION,
    attach_places,
    join_within,
    lookup_places,
    places_per_tile,
    with_projected,
    with_snapped,
)
from placetally.session import materialized

StopWords = DataFrame | Iterable[str] | None
SPOT_KEYS = ("spot_lon", "spot_lat")


def words_by_place(
    texts: DataFrame,
    features: DataFrame,
    props: Mapping[str, str],
    reach_m: float,
    tile_m: float,
    stopwords: StopWords,
    precision: int,
    snap: str,
    broadcast_bytes: int,
    rows_per_task: int,
    known: str | None = None,
    sides: int | None = None,
) -> DataFrame:
    """Counts ``n`` by place and word of texts that carry their lookup point.

    With a small lookup table texts get their place without moving, and only
    partial counts by place and word are shuffled.  With a large one, words are
    counted per lookup point: texts never move, copies collapse, and a crowded
    point is spread by its words.  Stop words leave after counting either way.
    Which way is known when the points have been looked up, so texts are read a
    second time; ``broadcast_bytes=0`` says it beforehand, and they are read once.
    """
    if broadcast_bytes <= 0:
        counted = word_counts(texts, list(CELL_KEYS), stopwords=stopwords).withColumnRenamed("count", "n")
        counted = materialized(counted, "words")
        lookup = lookup_places(
            counted, features, props, reach_m, tile_m, snap=snap, rows_per_task=rows_per_task, precision=precision,
            known=known, sides=sides,
        )
        return attach_places(counted, lookup, spread_by=["word"], broadcast_bytes=0, rows_per_task=rows_per_task)
    lookup = lookup_places(
        texts, features, props, reach_m, tile_m, snap=snap, rows_per_task=rows_per_task, precision=precision, known=known,
        sides=sides,
    )
    if lookup.fits_broadcast(broadcast_bytes):
        placed = attach_places(texts, lookup, broadcast_bytes=broadcast_bytes)
        counted = word_counts(placed, list(props), stopwords=stopwords)
        return counted.withColumnRenamed("count", "n")
    counted = word_counts(texts, list(lookup.keys), stopwords=stopwords).withColumnRenamed("count", "n")
    return attach_places(
        counted, lookup, spread_by=["word"], broadcast_bytes=broadcast_bytes, rows_per_task=rows_per_task
    )


def located_texts(posts: DataFrame, terms: Iterable[str], precision: int, snap: str) -> DataFrame:
    kept = filters.with_lonlat(filters.exclude_terms(posts, "description", terms))
    return with_snapped(kept, precision=precision, snap=snap).select("text", *CELL_KEYS)


def state_county_words(
    posts: DataFrame,
    counties: DataFrame,
    stopwords: StopWords = None,
    *,
    terms: Iterable[str] = filters.HR_TERMS,
    min_count: int = COUNTY_MIN_COUNT,
    precision: int = AREA_PRECISION,
    snap: str = "rounded",
    tile_m: float = COUNTY_TILE_M,
    broadcast_bytes: int = BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
    known: str | None = None,
) -> DataFrame:
    """``(word, state, county, count)`` nationwide, by state and by county.

    A post outside every county does not count at any level.
    """
    texts = located_texts(posts, terms, precision, snap)
    words = words_by_place(
        texts, counties, COUNTY_PROPS, 0, tile_m, stopwords, precision, snap, broadcast_bytes, rows_per_task,
        known,
    )
    return word_rollup(words, min_count=min_count, weight="n")


def metro_words(
    posts: DataFrame,
    metros: DataFrame,
    stopwords: StopWords = None,
    *,
    terms: Iterable[str] = filters.HR_TERMS,
    min_count: int = METRO_MIN_COUNT,
    max_distance_m: float = METRO_DISTANCE_M,
    precision: int = AREA_PRECISION,
    snap: str = "rounded",
    tile_m: float = METRO_TILE_M,
    broadcast_bytes: int = BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
    known: str | None = None,
    sides: int | None = None,
) -> DataFrame:
    """``(metro_area, word, count)`` of posts within reach of a metro area."""
    texts = located_texts(posts, terms, precision, snap)
    words = words_by_place(
        texts, metros, METRO_PROPS, max_distance_m, tile_m, stopwords, precision, snap, broadcast_bytes, rows_per_task,
        known, sides,
    )
    return metro_word_count(words, min_count=min_count, weight="n")


def poi_nearby(
    posts: DataFrame,
    pois: DataFrame,
    metros: DataFrame,
    *,
    domains: Iterable[str] = filters.SOURCE_DOMAINS,
    tag_keys: Iterable[str] = filters.POI_TAG_KEYS,
    radius_m: float = POI_DISTANCE_M,
    max_distance_m: float = METRO_DISTANCE_M,
    metro_precision: int = AREA_PRECISION,
    poi_precision: int = POI_PRECISION,
    snap: str = "rounded",
    tile_m: float = METRO_TILE_M,
    broadcast_bytes: int = BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
    known: str | None = None,
    sides: int | None = None,
) -> DataFrame:
    """``(metro_area, poi, count)``: posts within ``radius_m`` of a named point, same metro only.

    All posts of one lookup point see the same points of interest, so posts are
    first reduced to spots with a number of posts each.
    """
    if snap == "exact":
        raise ValueError("posts are searched from their cell: snap must be 'rounded' or 'center'")
    sent = filters.with_lonlat(filters.allow_sources(posts, "source", domains))
    sent = with_snapped(sent, precision=metro_precision, snap=snap)
    sent = with_snapped(sent, precision=poi_precision, snap=snap, names=SPOT_KEYS)
    # Both are far smaller than their inputs and needed more than once: stored,
    # they spare further passes over all posts and points.
    spots = materialized(sent.groupBy(*CELL_KEYS, *SPOT_KEYS).agg(F.count(F.lit(1)).alias("n")))
    named = filters.with_lonlat(filters.named_pois(pois, tag_keys), "coordinates").select("name", "lon", "lat")
    places = with_snapped(materialized(named.distinct()), precision=metro_precision, snap=snap)

    lookup = lookup_places(
        spots.select(*CELL_KEYS).unionByName(places.select(*CELL_KEYS)),
        metros, METRO_PROPS, max_distance_m, tile_m, snap=snap, rows_per_task=rows_per_task, precision=metro_precision,
        known=known, sides=sides,
    )
    spots = attach_places(spots, lookup, broadcast_bytes=broadcast_bytes, rows_per_task=rows_per_task)
    spots = with_projected(spots, *SPOT_KEYS)
    places = attach_places(
        places, lookup, spread_by=["name", "lon", "lat"], broadcast_bytes=broadcast_bytes, rows_per_task=rows_per_task
    )
    places = with_projected(places, names=("other_x", "other_y")).select("metro_area", "name", "other_x", "other_y")
    pairs = join_within(
        spots, places, radius_m, on=["metro_area"],
        spread_by=["name", "other_x", "other_y"], rows_per_task=rows_per_task,
        spots_per_tile=places_per_tile(poi_precision, snap, 4 * radius_m), sides=sides,
    )
    return poi_tweet_count(pairs, [*CELL_KEYS, *SPOT_KEYS])


def extract_pois(nodes: DataFrame, tag_keys: Sequence[str] = filters.POI_TAG_KEYS) -> DataFrame:
    """Point-of-interest log of a node table."""
    return filters.filter_poi_nodes(nodes, tag_keys)


def write_pois(nodes: DataFrame, path: str, tag_keys: Sequence[str] = filters.POI_TAG_KEYS, mode: str = "overwrite") -> None:
    """Filter nodes and write the log as JSON lines."""
    extract_pois(nodes, tag_keys).write.mode(mode).json(path)
