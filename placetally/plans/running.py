"""Word counts of a stream of posts: each batch adds its own, and the results of all batches can be read at any time."""

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from placetally.operators import filters
from placetally.operators.counts import COUNTY_MIN_COUNT, METRO_MIN_COUNT, metro_word_count, word_rollup
from placetally.operators.skew import ROWS_PER_TASK
from placetally.operators.spatial import (
    AREA_PRECISION,
    BROADCAST_BYTES,
    COUNTY_PROPS,
    COUNTY_TILE_M,
    METRO_DISTANCE_M,
    METRO_PROPS,
    METRO_TILE_M,
)
from placetally.plans.jobs import StopWords, located_texts, words_by_place
from placetally.session import scratch_scope
from placetally.sources.running_counts import FOLD_EVERY, add_counts, running_counts


def _add_words(
    posts: DataFrame,
    features: DataFrame,
    props: Mapping[str, str],
    reach_m: float,
    tile_m: float,
    path: str,
    checkpoint: str,
    stopwords: StopWords,
    terms: Iterable[str],
    precision: int,
    snap: str,
    broadcast_bytes: int,
    rows_per_task: int,
    fold_every: int,
    poll: str | None,
) -> StreamingQuery:
    def add(batch: DataFrame, number: int) -> None:
        with scratch_scope(batch.sparkSession):
            words = words_by_place(
                located_texts(batch, terms, precision, snap), features, props, reach_m, tile_m, stopwords, precision, snap,
                broadcast_bytes, rows_per_task, known=f"{path}/known",
            )
            add_counts(words, f"{path}/counts", number, [*props, "word"], "n", fold_every)

    writer = posts.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    return writer.trigger(**({"processingTime": poll} if poll else {"availableNow": True})).start()


def add_metro_words(
    posts: DataFrame,
    metros: DataFrame,
    path: str,
    checkpoint: str,
    stopwords: StopWords = None,
    *,
    terms: Iterable[str] = filters.HR_TERMS,
    max_distance_m: float = METRO_DISTANCE_M,
    precision: int = AREA_PRECISION,
    snap: str = "rounded",
    tile_m: float = METRO_TILE_M,
    broadcast_bytes: int = BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
    fold_every: int = FOLD_EVERY,
    poll: str | None = None,
) -> StreamingQuery:
    """Count the words of a stream of posts by metro area; read them with ``metro_words_so_far``.

    Answers of lookups are kept beside the counts, so a batch measures only the
    points that no batch before it has seen.  A batch reads its posts twice, as
    ``metro_words`` does, and leaves no intermediate files.  Metro areas should be a
    stored layer: every batch reads them.  Without ``poll`` the query handles
    what is there and stops.
    """
    return _add_words(
        posts, metros, METRO_PROPS, max_distance_m, tile_m, path, checkpoint, stopwords, terms, precision, snap,
        broadcast_bytes, rows_per_task, fold_every, poll,
    )


def metro_words_so_far(spark: SparkSession, path: str, min_count: int = METRO_MIN_COUNT) -> DataFrame:
    """``(metro_area, word, count)`` over all batches, as ``metro_words`` gives them for all posts at once."""
    words = running_counts(spark, f"{path}/counts", "metro_area string, word string")
    return metro_word_count(words, min_count=min_count, weight="count")


def add_state_county_words(
    posts: DataFrame,
    counties: DataFrame,
    path: str,
    checkpoint: str,
    stopwords: StopWords = None,
    *,
    terms: Iterable[str] = filters.HR_TERMS,
    precision: int = AREA_PRECISION,
    snap: str = "rounded",
    tile_m: float = COUNTY_TILE_M,
    broadcast_bytes: int = BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
    fold_every: int = FOLD_EVERY,
    poll: str | None = None,
) -> StreamingQuery:
    """Count the words of a stream of posts by county, as ``add_metro_words`` does by metro area."""
    return _add_words(
        posts, counties, COUNTY_PROPS, 0, tile_m, path, checkpoint, stopwords, terms, precision, snap,
        broadcast_bytes, rows_per_task, fold_every, poll,
    )


def state_county_words_so_far(spark: SparkSession, path: str, min_count: int = COUNTY_MIN_COUNT) -> DataFrame:
    """``(word, state, county, count)`` over all batches; the minimum applies to each level's own sum over all of them."""
    words = running_counts(spark, f"{path}/counts", "state string, county string, word string")
    return word_rollup(words, min_count=min_count, weight="count")
