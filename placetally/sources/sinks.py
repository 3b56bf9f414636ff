"""Writers of result tables."""

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placetally.operators.results import fresh_rows
from placetally.session import materialized

# Column order of each text result.
TSV_LAYOUTS = {
    "state_county_words": ("word", "state", "county", "count"),
    "metro_words": ("metro_area", "count", "word"),
    "poi_nearby": ("metro_area", "count", "poi"),
}
ABSENT = "None"
# An append lists up to this many metros for pruning.
MAX_LISTED = 10_000


def tsv_line(columns: Sequence[str]) -> Column:
    """Tab-separated text; an absent level is spelled ``None``."""
    return F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit(ABSENT)) for c in columns])


def as_tsv(df: DataFrame, kind: str) -> DataFrame:
    return df.select(tsv_line(TSV_LAYOUTS[kind]).alias("value"))


def write_tsv(df: DataFrame, kind: str, path: str, mode: str = "overwrite") -> None:
    as_tsv(df, kind).write.mode(mode).text(path)


def write_results(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    key: Sequence[str] = ("metro_area", "word"),
    partition: str = "metro_area",
) -> None:
    """Write a result table as Parquet, one folder per metro.

    ``append_ignore_duplicates`` adds only rows with a key the table does not
    hold yet; the new rows are stored first, so that they are computed once.
    Only the folders of metros that occur in them are read for that, if the metro
    is part of the key.  Rows are rebalanced by metro, so that small metros get
    one file and a large one is split over several tasks.
    """
    if mode == "append_ignore_duplicates":
        df = materialized(df, "results")  # read twice, for its metros and for its rows
        existing = _existing(df, path)
        if existing is not None:
            df = fresh_rows(touched(existing, df, partition) if partition in key else existing, df, key)
        else:
            df = fresh_rows(df.limit(0), df, key)
        mode = "append"
    elif mode not in ("overwrite", "append"):
        raise ValueError(f"unknown mode {mode!r}")
    df.hint("rebalance", partition).write.mode(mode).partitionBy(partition).parquet(path)


def touched(existing: DataFrame, new: DataFrame, partition: str) -> DataFrame:
    """Rows of ``existing`` in the partitions that occur in ``new``.

    Up to ``MAX_LISTED`` names become a filter that the scan prunes by.  With
    more of them most of the table is touched anyway, and it is joined whole.
    """
    names = [r[0] for r in new.select(partition).distinct().limit(MAX_LISTED + 1).collect()]
    if len(names) > MAX_LISTED:
        return existing
    wanted = F.col(partition).isin([n for n in names if n is not None])
    return existing.filter(wanted | F.col(partition).isNull() if None in names else wanted)


def _existing(df: DataFrame, path: str) -> DataFrame | None:
    try:
        return df.sparkSession.read.schema(df.schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_results(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Read a result table back with its declared schema."""
    return spark.read.schema(schema).parquet(path)
