"""Record filters and field extraction; all work on batch and streaming frames."""

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the filter rules; "builing" is spelled as the data rule has it.
POI_TAG_KEYS = ("amenity", "builing", "shop", "office", "tourism")
HR_TERMS = ("job", "hiring", "career")
SOURCE_DOMAINS = ("twitter.com", "foursquare.com", "instagram.com", "untappd.com")
CONTINENTAL_US = "-125.0011,24.9493,-66.9326,49.5904"
PORTLAND = "-123.784828,44.683842,-121.651703,46.188969"


def apply_steps(df: DataFrame, *steps: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Run processing steps in order; a step drops records by filtering them."""
    for step in steps:
        df = df.transform(step)
    return df


def _any_field(df: DataFrame, struct_name: str) -> Column:
    """True when the struct is there and at least one of its fields has a value."""
    fields = df.schema[struct_name].dataType.names
    present = F.lit(False)
    for name in fields:
        present = present | F.col(f"`{struct_name}`.`{name}`").isNotNull()
    return F.col(struct_name).isNotNull() & present


def filter_located(statuses: DataFrame) -> DataFrame:
    """Keep raw statuses that have both a user and coordinates."""
    return statuses.filter(_any_field(statuses, "user") & _any_field(statuses, "coordinates"))


def extract_fields(statuses: DataFrame) -> DataFrame:
    """Flatten a raw status into the columns of a post."""
    return statuses.select(
        F.col("user.id").alias("user_id"),
        F.col("user.name").alias("name"),
        F.col("user.screen_name").alias("screen_name"),
        F.col("user.description").alias("description"),
        F.col("user.location").alias("location"),
        F.col("user.friends_count").alias("friends_count"),
        F.col("user.followers_count").alias("followers_count"),
        "text",
        F.col("id_str").alias("tweet_id"),
        "source",
        "created_at",
        F.col("timestamp_ms").alias("timestamp"),
        F.col("coordinates.coordinates").alias("lonlat"),
    )


def parse_bbox(bbox: str | Sequence[float]) -> tuple[float, ...]:
    """``"SWlon,SWlat,NElon,NElat"`` as four numbers."""
    parts = bbox.split(",") if isinstance(bbox, str) else list(bbox)
    if len(parts) != 4:
        raise ValueError(f"a bounding box has the form 'sw-lon,sw-lat,ne-lon,ne-lat', not {bbox!r}")
    return tuple(float(part) for part in parts)


def filter_bbox(df: DataFrame, bbox: str | Sequence[float] = CONTINENTAL_US, lonlat: str = "lonlat") -> DataFrame:
    """Keep records whose point lies in the box, edges included."""
    west, south, east, north = parse_bbox(bbox)
    point = F.col(lonlat)
    return df.filter(F.get(point, F.lit(0)).between(west, east) & F.get(point, F.lit(1)).between(south, north))


def contains_any(text: Column, needles: Iterable[str]) -> Column:
    """True when the text holds one of the needles as a case-sensitive substring."""
    found = F.lit(False)
    for needle in needles:
        found = found | text.contains(needle)
    return found


def exclude_terms(df: DataFrame, column: str = "description", terms: Iterable[str] = HR_TERMS) -> DataFrame:
    """Drop records whose text mentions a term; an absent text passes."""
    return df.filter(~contains_any(F.coalesce(F.col(column), F.lit("")), terms))


def allow_sources(df: DataFrame, column: str = "source", domains: Iterable[str] = SOURCE_DOMAINS) -> DataFrame:
    """Keep records whose source mentions an accepted domain; an absent source is dropped."""
    return df.filter(contains_any(F.col(column), domains))


def has_tag(tags: Column, tag_keys: Iterable[str]) -> Column:
    return F.arrays_overlap(F.map_keys(tags), F.array(*[F.lit(key) for key in tag_keys]))


def filter_poi_nodes(nodes: DataFrame, tag_keys: Iterable[str] = POI_TAG_KEYS) -> DataFrame:
    """Map nodes that are points of interest, without their node id."""
    return nodes.filter(has_tag(F.col("tags"), tag_keys)).select("tags", "coordinates")


def named_pois(pois: DataFrame, tag_keys: Iterable[str] = POI_TAG_KEYS) -> DataFrame:
    """Points of interest that also carry a name, as ``(name, coordinates)``."""
    name = F.col("tags")["name"]
    return pois.filter(has_tag(F.col("tags"), tag_keys) & name.isNotNull()).select(
        name.alias("name"), "coordinates"
    )


def with_lonlat(df: DataFrame, point: str = "lonlat", lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Split a ``[lon, lat]`` column; records without a valid pair are dropped."""
    pair = F.col(point)
    return (
        df.filter(F.size(pair) == 2)
        .withColumn(lon, F.get(pair, F.lit(0)))
        .withColumn(lat, F.get(pair, F.lit(1)))
        .filter(F.col(lon).isNotNull() & F.col(lat).isNotNull())
    )
