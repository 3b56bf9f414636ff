"""Word extraction and exclusion of stop words."""

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placetally.functions.text import ascii_fold, tokens, trim_ends

MIN_WORD_LENGTH = 2


def explode_words(df: DataFrame, text: str = "text", name: str = "word") -> DataFrame:
    """One row per word occurrence, the text replaced by the word."""
    kept = [c for c in df.columns if c != text]
    folded = df.select(*kept, ascii_fold(F.col(text)).alias(text))
    exploded = folded.select(*kept, F.explode(tokens(F.col(text))).alias("token"))
    words = exploded.select(*kept, trim_ends(F.col("token")).alias(name))
    return words.filter(F.length(name) >= MIN_WORD_LENGTH)


def exclude_stopwords(
    df: DataFrame, stopwords: DataFrame | Iterable[str] | None, name: str = "word", strategy: str | None = None
) -> DataFrame:
    """Drop stop words, given as Python strings or as a one-column frame.

    The join moves every row of ``df`` if the stop list is too large to
    broadcast, and a frequent word is then one task's work.  Where counts are
    wanted, exclude from the counts (``counts.word_counts``): then each word is
    one row.  ``strategy`` is a join hint for the stop list.
    """
    if stopwords is None:
        return df
    if not isinstance(stopwords, DataFrame):
        listed = sorted(set(stopwords))
        if not listed:
            return df
        stopwords = df.sparkSession.createDataFrame([(word,) for word in listed], f"{name} string")
    stop = stopwords.select(F.col(stopwords.columns[0]).alias(name)).distinct()
    if strategy:
        stop = stop.hint(strategy)
    return df.join(stop, name, "left_anti").select(*df.columns)


def extract_words(
    df: DataFrame,
    text: str = "text",
    stopwords: DataFrame | Iterable[str] | None = None,
    name: str = "word",
) -> DataFrame:
    """Words of a text column: folded, split, cleaned, at least two long, no stop words."""
    return exclude_stopwords(explode_words(df, text, name), stopwords, name)
