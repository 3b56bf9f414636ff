"""Answers of lookups that are kept between runs."""

import hashlib
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placetally.session import materialized, read_if_there

POINT = ("lon", "lat")


def layer_version(features: DataFrame, props: Mapping[str, str], reach_m: float, sides: int | None = None) -> str:
    """A name that changes with the features, the properties asked for and the reach, but not with the order of rows."""
    named = [F.col("properties")[key] for key in props.values()]
    # a hash passes over nulls, so each property also tells whether it is one
    told = ["fid", "areal", "edges", *named, *[value.isNull() for value in named]]
    sums = [F.sum(F.xxhash64(*told, F.lit(seed)).cast("decimal(20,0)")) for seed in (1, 2)]
    seen = features.agg(*sums, F.count(F.lit(1))).first()
    shape = () if sides is None else (sides,)
    return hashlib.sha256(repr((*map(str, seen), list(props.items()), float(reach_m), *shape)).encode()).hexdigest()[:32]


@dataclass(frozen=True)
class KnownPlaces:
    """A Parquet folder with a row per point that has been looked up in one version of a layer; other layers have others."""

    path: str
    names: tuple[str, ...]

    @classmethod
    def of(
        cls, folder: str, features: DataFrame, props: Mapping[str, str], reach_m: float, sides: int | None = None
    ) -> "KnownPlaces":
        return cls(f"{folder.rstrip('/')}/layer-{layer_version(features, props, reach_m, sides)}", tuple(props))

    def answers(self, like: DataFrame) -> DataFrame:
        """(lon, lat, properties) of the points known so far; runs at the same time may both have stored a point."""
        schema = ", ".join([*(f"{axis} double" for axis in POINT), *(f"`{name}` string" for name in self.names)])
        stored = read_if_there(like.sparkSession, self.path, schema)
        return stored.groupBy(*POINT).agg(*[F.max(name).alias(name) for name in self.names])

    def completed(
        self, counted: DataFrame, keys: Sequence[str], answer: Callable[[DataFrame], DataFrame]
    ) -> tuple[DataFrame, int]:
        """``counted`` with the properties of its points, and how many of them had to be measured.

        Points without a coordinate have no place and are not kept.  Nothing is
        added where no point is new; a run that fails before its answers are
        added finds them missing the next time and measures them again.
        """
        renamed = dict(zip(POINT, keys))
        here = counted.select(*keys).filter(" and ".join(f"{key} is not null" for key in keys))
        known = self.answers(counted).select(*[F.col(axis).alias(key) for axis, key in renamed.items()])
        fresh = materialized(answer(here.join(known, list(keys), "left_anti")), "fresh")
        measured = fresh.count()
        if measured:
            added = fresh.select(*[F.col(key).alias(axis) for axis, key in renamed.items()], *self.names)
            added.write.mode("append").parquet(self.path)
        answers = self.answers(counted).select(*[F.col(axis).alias(key) for axis, key in renamed.items()], *self.names)
        return counted.join(answers, list(keys), "left"), measured
