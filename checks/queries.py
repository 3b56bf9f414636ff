"""One query per operator, over whole tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import inputs
from placetally import schemas
from placetally.operators import cell_tables, counts, filters, results, spatial, words
from placetally.plans import jobs, running
from placetally.session import materialized, scratch_path
from placetally.sources import boundaries, records, sinks, split_collections
from placetally.streaming import flows

# A short stop list for the queries; any list can be passed.
STOP_WORDS = ("the", "of", "and", "is", "la", "le", "des", "der", "und", "el", "los")
EXCLUDED = ("src7", "src13", "system")
CITY = (-96.4, 39.2)


def _doc_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = inputs.texts(spark, sf_dir, "documents", "lang", "source", "text")
    return words.extract_words(documents, "text", STOP_WORDS)


def _lang_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.metro_word_count(_doc_words(spark, sf_dir).withColumnRenamed("lang", "metro_area"))


def _benchmark_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.extract_words(inputs.texts(spark, sf_dir, "benchmark", "text")).distinct()


def word_extract_count(spark, sf_dir):
    """Words of all documents, words of the benchmark items being the stop words."""
    documents = inputs.texts(spark, sf_dir, "documents", "text")
    return counts.word_counts(documents, stopwords=_benchmark_words(spark, sf_dir))


def word_extract_count_shuffled(spark, sf_dir):
    """The same with no broadcast of the stop list."""
    documents = inputs.texts(spark, sf_dir, "documents", "text")
    return counts.word_counts(documents, stopwords=_benchmark_words(spark, sf_dir), strategy="merge")


def turn_words(spark, sf_dir):
    found = words.extract_words(inputs.texts(spark, sf_dir, "conversations", "role", "text"), "text", STOP_WORDS)
    return counts.count_groups(found, ["role", "word"])


def page_words(spark, sf_dir):
    """Raw pages hold URLs, entities and markup in plenty."""
    return counts.count_groups(words.extract_words(inputs.texts(spark, sf_dir, "pages", "html"), "html"), ["word"])


def exclude_terms(spark, sf_dir):
    posts = inputs.text_posts(spark, sf_dir)
    kept = filters.exclude_terms(posts, "description", EXCLUDED)
    return kept.groupBy("description").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"))


def allow_domains(spark, sf_dir):
    pages = inputs.table(spark, sf_dir, "pages").select("page_id", "url")
    return filters.allow_sources(pages, "url", ["example.com", "example.org"])


def allow_sources(spark, sf_dir):
    return filters.allow_sources(inputs.event_posts(spark, sf_dir)).select("tweet_id", "source")


def bbox_filter(spark, sf_dir):
    posts = filters.filter_bbox(inputs.event_posts(spark, sf_dir), "-110.5, 30.25, -85.125, 42")
    return posts.select("tweet_id", "user_id")


# One status in eleven has no time, one in thirteen an unreadable one.
STATUS_TIME = """case when event_id % 11 = 0 then null when event_id % 13 = 0 then 'soon'
    else cast(timestampdiff(MILLISECOND, timestamp_ntz'1970-01-01 00:00:00', ts) as string) end"""


def _statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as raw statuses; errors have no user, sign-ups no coordinates."""
    key = F.col("event_id")
    kind = F.col("event_type")
    user = F.struct(
        F.col("user_id").alias("id"),
        kind.alias("name"),
        F.concat(F.lit("u"), F.col("user_id")).alias("screen_name"),
        F.col("props").alias("description"),
        F.concat(F.lit("place "), F.col("user_id") % 7).alias("location"),
        (F.col("user_id") % 97).cast("int").alias("friends_count"),
        (F.col("user_id") % 89).cast("int").alias("followers_count"),
    )
    where = F.struct(
        F.lit("Point").alias("type"), F.array(inputs.lon_of("event_id"), inputs.lat_of("event_id")).alias("coordinates")
    )
    return inputs.table(spark, sf_dir, "events").select(
        F.when(kind != "error", user).alias("user"),
        F.col("props").alias("text"),
        key.cast("string").alias("id_str"),
        kind.alias("source"),
        F.expr("cast(cast(ts as date) as string)").alias("created_at"),
        F.expr(STATUS_TIME).alias("timestamp_ms"),
        F.when(kind != "signup", where).alias("coordinates"),
    )


def valid_posts(spark, sf_dir):
    posts = filters.apply_steps(_statuses(spark, sf_dir), filters.filter_located, filters.extract_fields)
    return posts.select(
        "tweet_id", "user_id", "name", "screen_name", "description", "location", "friends_count", "followers_count",
        "text", "source", "created_at", "timestamp",
        *(F.round(F.get("lonlat", F.lit(i)), 4).alias(name) for i, name in enumerate(("lon", "lat"))),
    )


def word_rollup(spark, sf_dir):
    found = _doc_words(spark, sf_dir).withColumnsRenamed({"lang": "state", "source": "county"})
    return counts.word_rollup(found)


def group_word_count(spark, sf_dir):
    return _lang_counts(spark, sf_dir)


def top_words(spark, sf_dir):
    return results.top_for_metro(_lang_counts(spark, sf_dir), "en", 25)


def all_words_of_group(spark, sf_dir):
    return results.top_for_metro(_lang_counts(spark, sf_dir), "de")


def distinct_groups(spark, sf_dir):
    return results.distinct_metros(_lang_counts(spark, sf_dir))


def find_where(spark, sf_dir):
    return results.find(_lang_counts(spark, sf_dir), (F.col("count") >= 10) & (F.col("metro_area") != "fr"), 0)


def find_limited(spark, sf_dir):
    found = results.find(_lang_counts(spark, sf_dir).orderBy(F.desc("count"), "metro_area", "word"), "count > 20", 40)
    return found.select("metro_area", "word", "count")


def group_documents(spark, sf_dir):
    batches = counts.documents_by_metro(_lang_counts(spark, sf_dir), per_batch=500)
    entry = F.transform("documents", lambda d: F.concat(d["word"], F.lit("="), d["count"].cast("string")))
    return batches.select(
        "metro_area", "batch", F.size("documents").alias("n"), F.array_join(entry, " ").alias("documents")
    )


def geohash_cells(spark, sf_dir):
    points = inputs.points(spark, sf_dir)
    for precision in (4, 7, 8):
        points = spatial.with_cell(points, precision=precision, name=f"cell{precision}")
    return points.select("event_id", "cell4", "cell7", "cell8")


def snap_points(spark, sf_dir):
    points = spatial.with_snapped(inputs.points(spark, sf_dir), precision=7, names=("lon7", "lat7"))
    points = spatial.with_snapped(points, precision=8, names=("lon8", "lat8"))
    points = spatial.with_snapped(points, precision=7, snap="center", names=("lon_c", "lat_c"))
    return points.select(
        "event_id", "lon7", "lat7", "lon8", "lat8", F.round("lon_c", 6).alias("lon_c"), F.round("lat_c", 6).alias("lat_c")
    )


def project_points(spark, sf_dir):
    projected = spatial.with_projected(inputs.points(spark, sf_dir))
    return projected.select("event_id", F.round("x", 1).alias("x"), F.round("y", 1).alias("y"))


def unproject_points(spark, sf_dir):
    points = spatial.with_projected(inputs.points(spark, sf_dir))
    back = spatial.with_unprojected(points, names=("lon_back", "lat_back"))
    return back.select("event_id", F.round("lon_back", 5).alias("lon_back"), F.round("lat_back", 5).alias("lat_back"))


def cell_reuse(spark, sf_dir):
    return spatial.cell_reuse_stats(inputs.points(spark, sf_dir))


def county_join(spark, sf_dir):
    located = spatial.join_containing(inputs.points(spark, sf_dir), inputs.zones(spark, sf_dir))
    return located.select("event_id", "state", "county")


def county_join_fine(spark, sf_dir):
    """A grid so fine that tiles may be crowded: they are split."""
    located = spatial.join_containing(
        inputs.points(spark, sf_dir), inputs.zones(spark, sf_dir), precision=8, snap="center", broadcast_bytes=0,
        rows_per_task=50,
    )
    return located.select("event_id", "state", "county")


def county_join_exact(spark, sf_dir):
    located = spatial.join_containing(
        inputs.points(spark, sf_dir), inputs.zones(spark, sf_dir), snap="exact", how="left"
    )
    return located.select("event_id", "state", "county")


def nearest_metro(spark, sf_dir):
    located = spatial.join_nearest(inputs.points(spark, sf_dir), inputs.metros(spark, sf_dir))
    return located.select("event_id", "metro_area")


def nearest_metro_shuffled(spark, sf_dir):
    """The same join without any broadcast of the lookup table."""
    located = spatial.join_nearest(inputs.points(spark, sf_dir), inputs.metros(spark, sf_dir), broadcast_bytes=0)
    return located.groupBy("metro_area", "event_type").agg(F.count(F.lit(1)).alias("n"))


def _pois_within(spark, sf_dir, **options):
    spots = (
        spatial.with_snapped(inputs.points(spark, sf_dir), precision=8)
        .groupBy("cell_lon", "cell_lat")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    others = filters.with_lonlat(inputs.nodes(spark, sf_dir), "coordinates").select("id", "lon", "lat")
    pairs = spatial.join_within(
        spatial.with_projected(spots, "cell_lon", "cell_lat"),
        spatial.with_projected(others, names=("other_x", "other_y")).select("id", "other_x", "other_y"),
        spread_by=["id"],
        spots_per_tile=spatial.places_per_tile(8, "rounded", 4 * spatial.POI_DISTANCE_M),
        **options,
    )
    return pairs.select("cell_lon", "cell_lat", "n", "id", F.round("dist", 1).alias("dist"))


def poi_within(spark, sf_dir):
    return _pois_within(spark, sf_dir)


def poi_within_cut(spark, sf_dir):
    """The same pairs from tiles that are cut again and again: a task takes few pairs."""
    return _pois_within(spark, sf_dir, rows_per_task=1_000)


def poi_within_polygon(spark, sf_dir):
    """Pairs within polygons of eight sides in the place of circles; the corners are on the circle."""
    return _pois_within(spark, sf_dir, sides=8)


def nearest_metro_polygon(spark, sf_dir):
    """The nearest metro area of those that meet the polygon of eight sides around a point."""
    located = spatial.join_nearest(inputs.points(spark, sf_dir), inputs.metros(spark, sf_dir), sides=8)
    return located.select("event_id", "metro_area")


def state_county_words(spark, sf_dir):
    return jobs.state_county_words(
        inputs.text_posts(spark, sf_dir), inputs.zones(spark, sf_dir), STOP_WORDS, terms=EXCLUDED
    )


def metro_words(spark, sf_dir):
    return jobs.metro_words(
        inputs.text_posts(spark, sf_dir), inputs.metros(spark, sf_dir), STOP_WORDS, terms=EXCLUDED
    )


def poi_nearby(spark, sf_dir):
    return jobs.poi_nearby(
        inputs.event_posts(spark, sf_dir), inputs.nodes(spark, sf_dir), inputs.metros(spark, sf_dir)
    )


def state_county_words_shuffled(spark, sf_dir):
    """The same job with no broadcast lookup and with crowded points split."""
    return jobs.state_county_words(
        inputs.text_posts(spark, sf_dir), inputs.zones(spark, sf_dir), STOP_WORDS, terms=EXCLUDED,
        broadcast_bytes=0, rows_per_task=2,
    )


def metro_words_shuffled(spark, sf_dir):
    return jobs.metro_words(
        inputs.text_posts(spark, sf_dir), inputs.metros(spark, sf_dir), STOP_WORDS, terms=EXCLUDED,
        snap="center", broadcast_bytes=0, rows_per_task=2,
    )


def poi_nearby_shuffled(spark, sf_dir):
    return jobs.poi_nearby(
        inputs.event_posts(spark, sf_dir), inputs.nodes(spark, sf_dir), inputs.metros(spark, sf_dir),
        broadcast_bytes=0, rows_per_task=2,
    )


def poi_nodes(spark, sf_dir):
    pois = jobs.extract_pois(inputs.nodes(spark, sf_dir))
    tag = F.array_join(F.array_sort(F.map_keys("tags")), ",")
    return pois.groupBy(tag.alias("keys")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.round(F.get("coordinates", F.lit(0)) * 10000).cast("bigint")).alias("lon_sum"),
    )


def named_pois(spark, sf_dir):
    named = filters.named_pois(inputs.nodes(spark, sf_dir))
    return filters.with_lonlat(named, "coordinates").select(
        "name", F.round("lon", 4).alias("lon"), F.round("lat", 4).alias("lat")
    )


def mixed_split(spark, sf_dir):
    """Posts and points of interest written side by side as JSON, read back and told apart."""
    path = scratch_path(spark, "mixed")
    posts = inputs.event_posts(spark, sf_dir).withColumn(
        "user_id", F.when(F.col("source").isNotNull(), F.col("user_id"))
    )
    records.union_records(posts, inputs.nodes(spark, sf_dir).drop("id")).write.json(path)
    kinds = records.read_mixed(spark, path)
    labelled = [
        frame.select(F.lit(kind).alias("kind"), "lonlat" if kind == "post" else
                     ("coordinates" if kind == "poi" else F.coalesce("lonlat", "coordinates").alias("at")))
        .toDF("kind", "at")
        for kind, frame in zip(("post", "poi", "rejected"), kinds)
    ]
    return (
        labelled[0].unionByName(labelled[1]).unionByName(labelled[2])
        .groupBy("kind")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.round(F.get("at", F.lit(1)) * 10000).cast("bigint")).alias("lat_sum"))
    )


def metro_sort(spark, sf_dir):
    """Points of interest and posts of each metro, points of interest first."""
    metros = inputs.metros(spark, sf_dir)
    pois = filters.with_lonlat(inputs.nodes(spark, sf_dir), "coordinates").select(
        F.lit(1).alias("type_tag"), F.col("id").alias("record"), "lon", "lat"
    )
    posts = inputs.points(spark, sf_dir).select(F.lit(2).alias("type_tag"), F.col("event_id").alias("record"), "lon", "lat")
    located = spatial.join_nearest(pois.unionByName(posts), metros)
    return results.sorted_by_metro(located, order=["type_tag", "record"]).select("metro_area", "type_tag", "record")


def near_points(spark, sf_dir):
    found = results.near(inputs.points(spark, sf_dir), *CITY, max_m=400_000)
    return found.select("event_id", F.round("distance_m", 1).alias("distance_m"))


def _points_by_cell(spark, sf_dir):
    path = scratch_path(spark, "cells")
    cell_tables.write_by_cell(inputs.points(spark, sf_dir), path, spread_by=["event_id"])
    return spark.read.parquet(path)


def near_by_cell(spark, sf_dir):
    """The same points from a table laid out by cell."""
    found = cell_tables.near(_points_by_cell(spark, sf_dir), *CITY, max_m=400_000)
    return found.select("event_id", F.round("distance_m", 1).alias("distance_m"))


def nearest_by_cell(spark, sf_dir):
    """The 300 points nearest to the city; equally near ones by id."""
    found = cell_tables.nearest(_points_by_cell(spark, sf_dir), *CITY, k=300, order=["event_id"])
    return found.select("event_id", F.round("distance_m", 1).alias("distance_m"))


def near_areas(spark, sf_dir):
    found = results.near_features(inputs.areas(spark, sf_dir), *CITY, max_m=150_000)
    return found.select("fid", F.round("distance_m", 2).alias("distance_m"))


def intersecting_areas(spark, sf_dir):
    found = results.intersecting(inputs.areas(spark, sf_dir), *CITY)
    return found.select("fid", F.col("properties")["NAME"].alias("name"))


def insert_ignore(spark, sf_dir):
    """Word counts of the documents, then those of the conversations with a new word."""
    existing = _lang_counts(spark, sf_dir).groupBy("word").agg(F.sum("count").alias("count"))
    turns = words.extract_words(inputs.texts(spark, sf_dir, "conversations", "role", "text"), "text", STOP_WORDS)
    new = counts.count_groups(turns, ["role", "word"]).select("word", "count")
    return results.insert_ignore(existing, new, ["word"])


def tsv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "tsv")
    sinks.write_tsv(word_rollup(spark, sf_dir), "state_county_words", path)
    return spark.read.text(path)


def result_sink_roundtrip(spark, sf_dir):
    """A result table written, then extended by the groups of another table."""
    path = scratch_path(spark, "results")
    sinks.write_results(_lang_counts(spark, sf_dir), path)
    turns = words.extract_words(inputs.texts(spark, sf_dir, "conversations", "role", "text"), "text", STOP_WORDS)
    by_role = counts.metro_word_count(turns.withColumnRenamed("role", "metro_area"))
    more = by_role.unionByName(_lang_counts(spark, sf_dir).withColumn("count", F.col("count") + 1))
    sinks.write_results(more, path, mode="append_ignore_duplicates")
    return sinks.read_results(spark, path, "word string, count bigint, metro_area string").select(
        "metro_area", "word", "count"
    )


def stopword_roundtrip(spark, sf_dir):
    """Words of the conversations as a stop-word file, read back without repeats."""
    path = scratch_path(spark, "stopwords")
    words.extract_words(inputs.texts(spark, sf_dir, "conversations", "text")).select("word").write.text(path)
    return records.read_stopwords(spark, path)


def metro_words_from_logs(spark, sf_dir):
    """From files to a text result: a post log, a boundary layer and a stop-word file."""
    log, layer, stop, out = (scratch_path(spark, n) for n in ("posts", "layer", "stop", "words"))
    inputs.text_posts(spark, sf_dir).write.json(log)
    inputs.write_layer(inputs.metros(spark, sf_dir), layer)
    spark.createDataFrame([(w,) for w in STOP_WORDS], "word string").write.text(stop)
    found = jobs.metro_words(
        records.read_posts(spark, log), boundaries.read_features(spark, layer, "UTF-8"), records.read_stopwords(spark, stop),
        terms=EXCLUDED,
    )
    sinks.write_tsv(found, "metro_words", out)
    return spark.read.text(out)


def poi_nearby_from_logs(spark, sf_dir):
    """From files to a text result: a post log, a point-of-interest log and a boundary layer."""
    log, pois, layer, out = (scratch_path(spark, n) for n in ("posts", "pois", "layer", "near"))
    inputs.event_posts(spark, sf_dir).write.json(log)
    jobs.write_pois(inputs.nodes(spark, sf_dir), pois)
    inputs.write_layer(inputs.metros(spark, sf_dir), layer)
    found = jobs.poi_nearby(
        records.read_posts(spark, log), records.read_pois(spark, pois), boundaries.read_features(spark, layer, "UTF-8")
    )
    sinks.write_tsv(found, "poi_nearby", out)
    return spark.read.text(out)


def feature_lines_roundtrip(spark, sf_dir):
    """The areas as lines, read back with numbers in their order."""
    path = scratch_path(spark, "lines")
    inputs.area_lines(spark, sf_dir).orderBy(F.expr("cast(get_json_object(value, '$.id') as bigint)")).write.text(path)
    layer = boundaries.read_feature_lines(spark, path)
    return layer.select(
        "fid", F.col("id").cast("bigint").alias("custkey"), F.col("properties")["NAME"].alias("name"),
        F.size("edges").alias("n_edges"), "minx", "miny", "maxx", "maxy",
    )


def feature_roundtrip(spark, sf_dir):
    """The areas as boundary files, read back with their edges and bounds."""
    path = scratch_path(spark, "layer")
    inputs.area_collections(spark, sf_dir).write.option("maxRecordsPerFile", 1).text(path)
    layer = boundaries.read_features(spark, path)
    return layer.select(
        F.col("id").cast("bigint").alias("custkey"),
        F.col("properties")["NAME"].alias("name"),
        F.size("edges").alias("n_edges"),
        "minx", "miny", "maxx", "maxy",
    )


def feature_split_roundtrip(spark, sf_dir):
    """The same files cut by byte ranges, whatever the features in them."""
    path = scratch_path(spark, "layer")
    inputs.area_collections(spark, sf_dir).write.option("maxRecordsPerFile", 1).text(path)
    layer = split_collections.read_split_features(spark, path)
    return layer.select(
        F.col("id").cast("bigint").alias("custkey"),
        F.col("properties")["NAME"].alias("name"),
        F.size("edges").alias("n_edges"),
        "minx", "miny", "maxx", "maxy",
    )


def _write_statuses(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "statuses")
    _statuses(spark, sf_dir).write.json(path)
    return path


def stream_to_log(spark, sf_dir):
    """A stream of raw statuses filtered, flattened and logged by the day."""
    log = scratch_path(spark, "log")
    flows.stream_to_log(
        spark, _write_statuses(spark, sf_dir), log, scratch_path(spark, "offsets"),
        bbox="-120,26,-80,45", minutes=1440,
    ).awaitTermination()
    logged_schema = T.StructType([*schemas.POST_SCHEMA.fields, T.StructField("slot", T.StringType())])
    logged = spark.read.schema(logged_schema).json(log)
    return logged.select("tweet_id", "user_id", "slot", "timestamp")


def ingest_archived(spark, sf_dir):
    """Closed log files shipped once, also when the flow runs again."""
    source = scratch_path(spark, "closed")
    inputs.event_posts(spark, sf_dir).write.json(source)
    target, offsets = scratch_path(spark, "shipped"), scratch_path(spark, "offsets")
    archive = scratch_path(spark, "archive")
    for _ in range(2):
        flows.ingest_archived(
            spark, source, target, offsets, archive_dir=archive, glob="part-*.json", output="parquet"
        ).awaitTermination()
    shipped = spark.read.schema(schemas.POST_SCHEMA).parquet(target)
    return filters.with_lonlat(shipped).select(
        "tweet_id", "user_id", "source", F.round("lon", 4).alias("lon"), F.round("lat", 4).alias("lat")
    )


def stream_then_ingest(spark, sf_dir):
    """Statuses logged by the day and the closed days shipped, in two rounds; every fiftieth status comes late."""
    source, log, closed, checkpoint, target = (scratch_path(spark, n) for n in ("statuses", "log", "closed", "offsets", "shipped"))
    late = F.col("id_str").cast("bigint") % 50 == 0
    for part in (~late, late):
        _statuses(spark, sf_dir).filter(part).write.mode("append").json(source)
        for query in flows.log_and_close(
            spark, source, log, closed, checkpoint, bbox="-120,26,-80,45", minutes=1440, delay="3 days"
        ):
            query.awaitTermination()
        flows.ingest_closed(spark, log, closed, target)
    return flows.read_shipped(spark, target).select("tweet_id", "user_id", "timestamp")


def _in_two_rounds(spark, sf_dir, start):
    """Posts that arrive in two rounds: the stream counts the first, stops, and goes on with the second."""
    source, offsets = scratch_path(spark, "posts"), scratch_path(spark, "offsets")
    posts = inputs.text_posts(spark, sf_dir)
    second = F.xxhash64("user_id", "text") % 2 == 0
    for part in (~second, second):
        posts.filter(part).write.mode("append").parquet(source)
        start(spark.readStream.schema(posts.schema).parquet(source), offsets).awaitTermination()


def metro_words_incremental(spark, sf_dir):
    """Counts of two batches are those of one run; the second batch looks up only points that the first has not seen."""
    path = scratch_path(spark, "counts")
    metros = materialized(inputs.metros(spark, sf_dir), "layer")
    _in_two_rounds(spark, sf_dir, lambda posts, offsets: running.add_metro_words(
        posts, metros, path, offsets, STOP_WORDS, terms=EXCLUDED
    ))
    return running.metro_words_so_far(spark, path)


def state_county_words_incremental(spark, sf_dir):
    path = scratch_path(spark, "counts")
    zones = materialized(inputs.zones(spark, sf_dir), "layer")
    _in_two_rounds(spark, sf_dir, lambda posts, offsets: running.add_state_county_words(
        posts, zones, path, offsets, STOP_WORDS, terms=EXCLUDED, fold_every=2
    ))
    return running.state_county_words_so_far(spark, path)


def nearest_metro_known(spark, sf_dir):
    """Answers of a first run serve a second one, and the figures of a lookup need no pass of their own."""
    known, layer = scratch_path(spark, "known"), materialized(inputs.metros(spark, sf_dir), "layer")
    points = spatial.with_snapped(inputs.points(spark, sf_dir))
    first, second = (
        spatial.lookup_places(points, layer, spatial.METRO_PROPS, spatial.METRO_DISTANCE_M, spatial.METRO_TILE_M, known=known)
        for _ in range(2)
    )
    located = spatial.attach_places(points, second).groupBy("metro_area").agg(F.count(F.lit(1)).alias("n"))
    figures = {"first_hits": first.hits, "first_misses": first.misses, "second_hits": second.hits, "second_misses": second.misses}
    return located.withColumns({name: F.lit(value).cast("bigint") for name, value in figures.items()})


QUERIES = {
    f.__name__: f
    for f in (
        word_extract_count, word_extract_count_shuffled, turn_words, page_words,
        exclude_terms, allow_domains, allow_sources, bbox_filter, valid_posts,
        word_rollup, group_word_count, top_words, all_words_of_group, distinct_groups,
        find_where, find_limited, group_documents,
        geohash_cells, snap_points, project_points, unproject_points, cell_reuse,
        county_join, county_join_fine, county_join_exact, nearest_metro, nearest_metro_shuffled, poi_within,
        poi_within_cut, poi_within_polygon, nearest_metro_polygon,
        state_county_words, metro_words, poi_nearby,
        state_county_words_shuffled, metro_words_shuffled, poi_nearby_shuffled,
        poi_nodes, named_pois, mixed_split, metro_sort,
        near_points, near_by_cell, nearest_by_cell, near_areas, intersecting_areas, insert_ignore,
        tsv_roundtrip, result_sink_roundtrip, stopword_roundtrip, feature_roundtrip, feature_lines_roundtrip,
        feature_split_roundtrip,
        metro_words_from_logs, poi_nearby_from_logs,
        stream_to_log, ingest_archived, stream_then_ingest,
        metro_words_incremental, state_county_words_incremental, nearest_metro_known,
    )
}
