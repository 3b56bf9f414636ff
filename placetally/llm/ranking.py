"""Places of rows in a total order, without one task that sees them all."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placetally.llm.common import stored

ROWS_PER_TASK = 1_000_000
PART, WITHIN = "_part", "_within"


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, at = TaskContext.get().partitionId(), 0
    for batch in batches:
        columns = [*batch.columns, pa.array(np.full(batch.num_rows, part, np.int32)), pa.array(np.arange(at, at + batch.num_rows))]
        at += batch.num_rows
        yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, PART, WITHIN])


def in_order(rows: DataFrame, group: str, order: list[Column], label: str) -> DataFrame:
    """The rows with ``position`` (from 0) and ``members`` (number of rows) within their ``group``, null being one.

    ``rows`` must be stored, as the borders of the ranges come from a pass of its
    own.  They are dealt by ranges of group and order, so a large group is split;
    the counts of its ranges, one row for each range and group, give the offsets.
    ``order`` must be total, or the rows that tie interchangeable.
    """
    ranges = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // ROWS_PER_TASK))
    dealt = rows.repartitionByRange(ranges, F.col(group).asc_nulls_first(), *order)
    dealt = dealt.sortWithinPartitions(F.col(group).asc_nulls_first(), *order)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    dealt = stored(dealt.mapInArrow(_numbered, f"{schema}, {PART} int, {WITHIN} long"), label)
    pieces = dealt.groupBy(group, PART).agg(F.min(WITHIN).alias("first"), F.count("*").alias("n"))
    whole = Window.partitionBy(group)
    before = whole.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(
        pieces.select(
            F.col(group).alias("of"), F.col(PART).alias("in"), (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"),
            F.sum("n").over(whole).alias("members"),
        ), f"{label}-offsets",
    )
    placed = dealt.join(offsets, dealt[group].eqNullSafe(offsets["of"]) & (dealt[PART] == offsets["in"]))
    return placed.withColumn("position", F.col(WITHIN) + F.col("shift")).drop(PART, WITHIN, "of", "in", "shift")
