"""Counts that grow batch by batch: sums below a minimum are kept until later batches lift them over it."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placetally.operators.counts import count_groups
from placetally.session import read_if_there

DONE = "_done"
DONE_SCHEMA = "sums_to boolean, number bigint"
# So many batches are summed up into one table, to bound what a reader opens.
FOLD_EVERY = 64


def _done(spark: SparkSession, path: str) -> tuple[int | None, list[int]]:
    """The batch up to which there is a table of sums, and the finished batches after it."""
    noted = read_if_there(spark, f"{path}/{DONE}", DONE_SCHEMA)
    base = noted.filter("sums_to").agg(F.max("number")).first()[0]
    later = noted.filter("not sums_to").filter(F.col("number") > F.lit(-1 if base is None else base))
    return base, sorted({r.number for r in later.select("number").distinct().collect()})


def _note(spark: SparkSession, path: str, sums_to: bool, number: int) -> None:
    spark.createDataFrame([(sums_to, number)], DONE_SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/{DONE}")


def add_counts(counts: DataFrame, path: str, number: int, keys: Sequence[str], weight: str = "n", fold_every: int = FOLD_EVERY) -> None:
    """Add the sums of batch ``number`` (0 or more, ascending), all of them, however small.

    A batch counts when its number is written down after its rows.  One that is
    written down already is left alone, so a stream that repeats its last batch
    after a failure counts it once.  One writer at a time.
    """
    spark = counts.sparkSession
    base, later = _done(spark, path)
    if number in later or (base is not None and number <= base):
        return
    count_groups(counts, keys, weight).write.mode("overwrite").parquet(f"{path}/batch-{number}")
    _note(spark, path, False, number)
    if len(later) + 1 >= fold_every:
        summed = _parts(spark, path, base, [*later, number])
        count_groups(summed, keys, "count").write.mode("overwrite").parquet(f"{path}/sums-{number}")
        _note(spark, path, True, number)


def _parts(spark: SparkSession, path: str, base: int | None, later: Sequence[int], schema: str | None = None) -> DataFrame:
    names = ([] if base is None else [f"{path}/sums-{base}"]) + [f"{path}/batch-{n}" for n in later]
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(*names)


def running_counts(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Key columns and ``count`` of all batches; ``schema`` lists the keys with their types.

    A batch that was written down while this is read is in the result or is not.
    Without any batch there are no rows.
    """
    base, later = _done(spark, path)
    whole = f"{schema}, count bigint"
    if base is None and not later:
        return spark.createDataFrame([], whole)
    rows = _parts(spark, path, base, later, whole)
    return count_groups(rows, [c for c in rows.columns if c != "count"], "count")
