"""Helpers that the operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession

from placetally.session import scratch_path

WHITE_SPACE = b" \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write the rows as Parquet to the shared folder and go on from there.

    The files outlive lost executors and cut the lineage.  They stay until the
    shared folder is cleaned (``clear_scratch``), because results are read from
    them lazily.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def mixed(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the 64 bits of a hash."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def texts_of(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column as UTF-8; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def fresh(name: str, taken: list[str]) -> str:
    """A column name like ``name`` that is not taken."""
    while name.lower() in {t.lower() for t in taken}:
        name = f"_{name}"
    return name


def replaced(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    return batch.set_column(batch.schema.get_field_index(name), batch.schema.field(name), values)


def slices(batch: pa.RecordBatch, text: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch with about ``limit`` bytes of text; a longer text is a piece of its own."""
    if not batch.num_rows:
        return
    sizes = batch.column(text).cast(pa.binary())
    lengths = np.array([0 if n is None else n for n in pa.compute.binary_length(sizes).to_pylist()], np.int64)
    part = (np.cumsum(lengths) - lengths) // limit
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(edges, edges[1:]):
        yield batch.slice(a, b - a)
