"""Counts by place and word, and their documents."""

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placetally.operators.skew import heaviest, split_join
from placetally.operators.words import exclude_stopwords, explode_words
from placetally.session import materialized

COUNTY_MIN_COUNT = 5
METRO_MIN_COUNT = 2
DOCUMENTS_PER_BATCH = 1_000


def count_groups(df: DataFrame, keys: Sequence[str], weight: str | None = None) -> DataFrame:
    """Rows (or summed weights) per key, combined before the shuffle."""
    amount = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return df.groupBy(*keys).agg(amount.cast("bigint").alias("count"))


def word_counts(
    df: DataFrame,
    keys: Sequence[str] = (),
    text: str = "text",
    stopwords: DataFrame | Iterable[str] | None = None,
    name: str = "word",
    strategy: str | None = None,
) -> DataFrame:
    """Counts by keys and word of a text column, without stop words.

    Words are counted first, combined before the shuffle; stop words then leave
    the counts, where each word is one row per key.
    """
    words = explode_words(df.select(*keys, text), text, name)
    return exclude_stopwords(count_groups(words, [*keys, name]), stopwords, name, strategy)


def word_rollup(
    words: DataFrame,
    levels: Sequence[str] = ("word", "state", "county"),
    min_count: int = COUNTY_MIN_COUNT,
    weight: str | None = None,
) -> DataFrame:
    """Counts by ``(word)``, ``(word, state)`` and ``(word, state, county)``.

    The finest level is counted first; the roll-up then works on its groups and
    not on the occurrences.  The minimum applies to each level's own sum.
    """
    finest = count_groups(words, levels, weight)
    sets = [[F.col(c) for c in levels[: depth + 1]] for depth in range(len(levels))]
    rolled = finest.groupingSets(sets, *[F.col(c) for c in levels]).agg(F.sum("count").alias("total"))
    return rolled.filter(F.col("total") >= min_count).select(*levels, F.col("total").alias("count"))


def metro_word_count(
    words: DataFrame,
    group: str = "metro_area",
    word: str = "word",
    min_count: int = METRO_MIN_COUNT,
    weight: str | None = None,
) -> DataFrame:
    """Counts by place and word, at least ``min_count``."""
    return count_groups(words, [group, word], weight).filter(F.col("count") >= min_count)


def poi_tweet_count(pairs: DataFrame, keys: Sequence[str], weight: str = "n", metro: str = "metro_area", name: str = "name") -> DataFrame:
    """Posts near each point-of-interest name.

    ``pairs`` holds a spot (its ``keys`` and the number of posts there) per
    nearby point.  A post counts a name once, however many points share it.
    """
    once = pairs.groupBy(metro, *keys, name).agg(F.max(weight).alias(weight))
    return once.groupBy(metro, F.col(name).alias("poi")).agg(F.sum(weight).cast("bigint").alias("count"))


def documents_by_metro(
    df: DataFrame,
    label: str = "word",
    metro: str = "metro_area",
    per_batch: int = DOCUMENTS_PER_BATCH,
) -> DataFrame:
    """Documents of each metro in batches of about ``per_batch``, each sorted by label.

    A metro with many results becomes many batches, so no single row or task has
    to hold all of them.  The batch of a result follows from its label alone.
    The results and their number by metro are stored first, so that what makes
    them runs once; this starts two Spark jobs at once.
    """
    df = materialized(df, "results")
    counted = materialized(count_groups(df, [metro]), "sizes")
    batches = counted.select(metro, F.ceil(F.col("count") / F.lit(per_batch)).cast("bigint").alias("batches"))
    prefix = F.conv(F.substring(F.md5(F.col(label)), 1, 8), 16, 10).cast("bigint")
    document = F.struct(F.col(label), F.col("count"))
    return (
        split_join(df, batches, [metro], spread_by=[label], hot=heaviest(counted, [metro]))
        .withColumn("batch", F.pmod(prefix, F.col("batches")))
        .groupBy(metro, "batch")
        .agg(F.array_sort(F.collect_list(document)).alias("documents"))
    )
