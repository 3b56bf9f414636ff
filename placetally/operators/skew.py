"""Equi-join that spreads a key holding a large share of one side over many tasks."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_PER_TASK = 1_000_000
# A key is split from this share of all rows on, if that is more than the rows
# of a task.  The list of split keys thus has at most as many entries as the
# share goes into one, whatever the input, and every key over the threshold is
# on it.
LEAST_SHARE = 1e-6
# Helper columns of the join; they do not reach its result.
PART, PARTS = "_split_part", "_split_parts"


def heaviest(counted: DataFrame, on: Sequence[str], rows_per_task: int = ROWS_PER_TASK, amount: str = "count") -> DataFrame:
    """Every counted key over the threshold and in how many parts it is to be split."""
    total = counted.agg(F.sum(amount)).scalar()
    threshold = F.greatest(F.lit(rows_per_task), F.floor(total * F.lit(LEAST_SHARE)))
    return counted.filter(F.col(amount) > threshold).select(
        *on, F.ceil(F.col(amount) / F.lit(rows_per_task)).cast("int").alias(PARTS)
    )


def heavy_keys(df: DataFrame, on: Sequence[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The heavy keys of a frame.

    The count is combined before its shuffle, so a hot key costs one row per task.
    """
    return heaviest(df.groupBy(*on).count(), on, rows_per_task)


def split_join(
    large: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    how: str = "inner",
    rows_per_task: int = ROWS_PER_TASK,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Join in which hot keys of ``large`` are cut into parts by a hash of ``spread_by``.

    Rows of ``small`` are repeated once per part, for hot keys only.  The part
    depends on nothing but the row, so a task that runs again gives the same
    rows.  The list of hot keys is limited by the threshold (``LEAST_SHARE``),
    which is why it may be broadcast; pass it as ``hot`` where counts are at
    hand.
    """
    on = list(on)
    hot = F.broadcast(heavy_keys(large, on, rows_per_task) if hot is None else hot)
    parts = F.coalesce(F.col(PARTS), F.lit(1))
    spread = (
        large.join(hot, on, "left")
        .withColumn(PART, F.pmod(F.xxhash64(*spread_by), parts).cast("int"))
        .drop(PARTS)
    )
    repeated = (
        small.join(hot, on, "left")
        .withColumn(PART, F.explode(F.sequence(F.lit(0), parts - F.lit(1))))
        .drop(PARTS)
    )
    return spread.join(repeated, [*on, PART], how).drop(PART)
