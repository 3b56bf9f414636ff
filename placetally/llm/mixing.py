"""Mixing of sources to target weights by pivotal dependent rounding.

Every document of a source has the same expected number of copies.  The whole part is certain; the rest is a fractional
copy, that is a mass of words.  Two documents with fractional copies play: one gives mass to the other until one of them
is all or nothing, and chance decides who gives, so that expectations stay.  The mass of a source never changes on the
way; only the last document of a source is rounded alone.  Groups of bounded size play in parallel; what is left of each
(one document) plays in the next level of a tree.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placetally.llm.common import fresh, stored

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0
GROUP_ROWS = 4_096
FAN_IN = 64
SEED = 17
# A group plays again, so many times at most, while what one document is left with is over this share of the group.
ATTEMPTS = 16
NEAR = 1e-3

UNIT = "doc_id {0}, source {1}, size long, n long, source_size long, target double, leaf long, parts long, whole long, p double"


def word_count(text: str) -> Column:
    """Number of runs of anything but ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(source, docs, source_size, target) of ``sizes`` (source, size): words that the mix shall take of each source.

    Sources in code point order, null last, have the ``weights`` in turn and
    share ``share`` times all words.  A source stops at ``cap`` times its size;
    what it cannot take is shared again by weight.
    """
    sums = sizes.groupBy("source").agg(F.count("*").alias("docs"), F.sum("size").alias("source_size"))
    by = F.col("source").asc_nulls_last()
    ordered = stored(
        sums.repartitionByRange(by).sortWithinPartitions(by).withColumns(
            {"part": F.spark_partition_id(), "at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}
        ),
        "sources",
    )
    rows = {r["part"]: r["count"] for r in ordered.groupBy("part").count().collect()}
    rank, before = F.lit(0).cast("long"), 0
    for part in sorted(rows):
        rank = F.when(F.col("part") == part, F.col("at") + before).otherwise(rank)
        before += rows[part]
    turns = F.array(*(F.lit(w) for w in weights))
    weighed = stored(
        ordered.select("source", "docs", "source_size", turns[(rank % len(weights)).cast("int")].alias("weight")), "weights"
    )
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:
        # words a unit of weight, given the sources that are full at the level so far
        full = F.col("weight") * F.lit(level) >= F.col("source_size") * F.lit(cap)
        taken, open_ = weighed.agg(
            F.sum(F.when(full, F.col("source_size"))), F.sum(F.when(~full, F.col("weight")))
        ).first()
        raised = (share * total - cap * (taken or 0)) / open_ if open_ else level
        if raised <= level:
            break
        level = raised
    target = F.least(F.col("source_size") * F.lit(cap), F.col("weight") * F.lit(level))
    return weighed.select("source", "docs", "source_size", target.alias("target"))


def play(sizes: np.ndarray, p: np.ndarray, chance: np.random.Generator) -> tuple[np.ndarray, int]:
    """Play the fractional copies ``p`` in the given order; returns them (0, 1 or, at one place, between) and the place.

    The sum of ``sizes * p`` stays.  The place is -1 if nothing is left over.
    """
    p = p.tolist()
    size = sizes.tolist()
    draws = chance.random(len(p)).tolist()
    i = -1
    for j in range(len(p)):
        if not 0 < p[j] < 1:
            continue
        if i < 0:
            i = j
            continue
        mi, mj = p[i] * size[i], p[j] * size[j]
        up, down = min(size[i] - mi, mj), min(mi, size[j] - mj)
        if draws[j] * (up + down) < down:
            if up == mj:
                p[i], p[j] = (mi + up) / size[i], 0.0
            else:
                p[i], p[j] = 1.0, (mj - up) / size[j]
        elif down == mi:
            p[i], p[j] = 0.0, (mj + down) / size[j]
        else:
            p[i], p[j] = (mi - down) / size[i], 1.0
        left = [k for k in (i, j) if 1e-12 < p[k] < 1 - 1e-12]
        for k in (i, j):
            if k not in left:
                p[k] = float(round(p[k]))
        i = left[0] if left else -1
    return np.array(p), i


def _seed(*values) -> np.random.Generator:
    return np.random.default_rng([SEED, *(int(v) & 0xFFFFFFFF for v in values)])


def copies(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(doc_id, source, size, n, source_size, target, copies): how often the mix takes each document.

    Rows with equal doc_id, source and size are one document with ``n`` rows,
    which all get the same number of copies.  Null texts have size 0 and a null
    source is a source; documents without words take no part in the play and
    get the certain copies.  The same table gives the same mix.
    """
    sized = docs.select("doc_id", "source", word_count("text").alias("size"))
    units = stored(sized.groupBy("doc_id", "source", "size").agg(F.count("*").alias("n")), "sizes")
    goals = stored(targets(units.select("source", (F.col("size") * F.col("n")).alias("size")), weights, share, cap), "targets")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # every source's groups are known by its number of documents; a salt deals a large source over the join's tasks
    salts = 32
    salted = goals.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).withColumnRenamed("source", "of")
    placed = units.withColumn("salt", F.pmod(F.xxhash64("doc_id", "size"), F.lit(salts)).cast("int"))
    placed = placed.join(salted, placed["source"].eqNullSafe(salted["of"]) & (placed["salt"] == salted["salt"])).select(
        "doc_id", "source", "size", "n", "source_size", "target",
        F.pmod(F.xxhash64("size", "doc_id"), F.ceil(F.col("docs") / GROUP_ROWS)).alias("leaf"),
        F.ceil(F.col("docs") / GROUP_ROWS).alias("parts"),
        F.floor(ratio).cast("long").alias("whole"), (ratio - F.floor(ratio)).alias("p"),
    )
    kinds = [units.schema[c].dataType.simpleString() for c in ("doc_id", "source")]
    shape = UNIT.format(*kinds)
    most = goals.agg(F.max(F.ceil(F.col("docs") / GROUP_ROWS))).first()[0] or 0
    settled, left, depth = None, placed, 0
    while True:
        played = stored(left.groupBy("source", "leaf").applyInArrow(_player(depth), shape), "play")
        done = played.filter("p = 0 or p = 1")
        settled = done if settled is None else settled.union(done)
        left = played.filter("p > 0 and p < 1").withColumn("leaf", F.floor(F.col("leaf") / FAN_IN))
        if most <= 1:
            break
        most, depth = -(-most // FAN_IN), depth + 1
    # the last document of a source is rounded to the nearer side, which keeps the source nearest to its target
    settled = settled.union(left.withColumn("p", F.when(F.col("p") >= 0.5, 1.0).otherwise(0.0)))
    return settled.select(
        "doc_id", "source", "size", "n", "source_size", "target", (F.col("whole") + F.col("p").cast("long")).alias("copies")
    )


def _player(depth: int):
    def played(key: tuple, group: pa.Table) -> pa.Table:
        order = pa.compute.sort_indices(group, [("size", "descending"), ("doc_id", "ascending")])
        group = group.take(order)
        weight = group["size"].to_numpy() * group["n"].to_numpy()
        p = np.where(weight > 0, group["p"].to_numpy(), 0.0)
        best, least = p, float("inf")
        for attempt in range(ATTEMPTS):
            tried, at = play(weight, p, _seed(depth, key[1].as_py(), len(group), int(weight.sum()), attempt))
            miss = 0.0 if at < 0 else weight[at] * min(tried[at], 1 - tried[at])
            if miss < least:
                best, least = tried, miss
            if least <= NEAR * float((weight * p).sum()):
                break
        return group.set_column(group.schema.get_field_index("p"), "p", pa.array(best, pa.float64()))

    return played


def mix_sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row of ``docs``: ``taken`` words go into the mix."""
    each = copies(docs).withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    return each.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mix(docs: DataFrame) -> DataFrame:
    """The mix: ``docs`` with each row as often as it is taken, numbered from 1 in a new last column ``copy``."""
    names: list[str] = []
    for name in ("words", "of_id", "of_source", "of_size", "copies", "copy"):
        names.append(fresh(name, docs.columns + names))
    words, doc_id, source, size, times, number = names
    plan = copies(docs).filter("copies > 0").select(
        F.col("doc_id").alias(doc_id), F.col("source").alias(source), F.col("size").alias(size), F.col("copies").alias(times)
    )
    on = F.col("doc_id").eqNullSafe(F.col(doc_id)) & F.col("source").eqNullSafe(F.col(source)) & (F.col(words) == F.col(size))
    taken = docs.withColumn(words, word_count("text")).join(plan, on)
    taken = taken.withColumn(number, F.explode(F.sequence(F.lit(1).cast("long"), F.col(times))))
    return taken.select(*docs.columns, number)
