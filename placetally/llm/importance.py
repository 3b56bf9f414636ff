"""Importance resampling towards a target distribution, on hashed word features.

Every feature (a run of words) falls into a bucket by its CRC-32.  The different
features of some texts are grouped by length into byte matrices, whose registers
are updated column by column; the buckets are then scattered back to the places
of the features.  A bucket's gain is the logarithm of how much likelier it is in
the target than in the documents; a document weighs the mean of its gains.
Adding noise of the Gumbel distribution and taking the highest sums draws
documents without replacement, in proportion to their weights.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placetally.llm.common import slices, stored, texts_of
from placetally.llm.crc import crc32_of
from placetally.llm.ranking import in_order

BUCKETS = 10_000
GRAMS = 1
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
SCALE = 1000
TEXT_BYTES = 2 << 20
_LETTERS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b > 0x7F else 0x20 for b in range(256)
)


def words_in_parts(text: bytes, overlap: int) -> Iterator[list[bytes]]:
    """Words of a text, lower-cased; a long one comes in parts that begin with the last ``overlap`` words before."""
    at, before = 0, []
    while at < len(text):
        part = text[at:at + TEXT_BYTES].translate(_LETTERS)
        end = at + len(part)
        if end < len(text):  # to the end of the word that the part cuts
            rest = end
            while rest < len(text) and _LETTERS[text[rest]] != 0x20:
                rest += 1
            part += text[end:rest].translate(_LETTERS)
            end = rest
        own = part.split()
        yield before + own
        before, at = (before + own)[-overlap:] if overlap else [], end


def _features(words: list[bytes], grams: int, carried: int) -> list[bytes]:
    """Runs of 1 to ``grams`` words that end after the first ``carried`` ones."""
    out = words[carried:]
    for n in range(2, grams + 1):
        first = max(0, carried - n + 1)
        out.extend(b" ".join(run) for run in zip(*(words[first + k:] for k in range(n))))
    return out


class _Buckets:
    """Buckets of features that have been seen; forgotten when there are many."""

    LIMIT = 500_000

    def __init__(self, buckets: int):
        self.buckets, self.known = buckets, {}

    def of(self, features: list[bytes]) -> np.ndarray:
        new = set(features).difference(self.known)
        if len(self.known) + len(new) > self.LIMIT:
            self.known, new = {}, set(features)
        for word, crc in crc32_of(new).items():
            self.known[word] = crc % self.buckets
        return np.fromiter(map(self.known.__getitem__, features), np.int32, len(features))


def _grouped(texts: list[bytes], grams: int) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """(text of each run of features, its length, the features, number of words) over all texts, in bounded parts."""
    rows, sizes, words, held = [], [], [], []
    for row, text in enumerate(texts):
        carried = 0
        for part in words_in_parts(text, grams - 1):
            own = _features(part, grams, carried)
            rows.append(row)
            sizes.append(len(own))
            words.append(len(part) - carried)
            held.extend(own)
            carried = min(len(part), grams - 1)
            if len(held) > TEXT_BYTES // 4:
                yield np.array(rows), np.array(sizes), np.array(words), held
                rows, sizes, words, held = [], [], [], []
    if rows:
        yield np.array(rows), np.array(sizes), np.array(words), held


def _counts(batches: Iterator[pa.RecordBatch], grams: int, buckets: int) -> Iterator[pa.RecordBatch]:
    total, seen = np.zeros(buckets, np.int64), _Buckets(buckets)
    for batch in batches:
        for piece in slices(batch, "text", TEXT_BYTES):
            for _, _, _, held in _grouped(texts_of(piece.column("text")), grams):
                total += np.bincount(seen.of(held), minlength=buckets)
    full = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(total[full])], ["bucket", "n"])


def bucket_counts(texts: DataFrame, grams: int = GRAMS, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): how many features of all texts fall into each bucket, repeats counted; empty buckets are left out."""
    counted = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(
        partial(_counts, grams=grams, buckets=buckets), "bucket int, n long"
    )
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    """Gain of each bucket, in thousandths, from the counts of both sides."""
    s, t = sum(source.values()), sum(target.values())
    out = np.zeros(buckets, np.int64)
    for b in range(buckets):
        up = float(target.get(b, 0) + 1) * float(s + buckets)
        down = float(source.get(b, 0) + 1) * float(t + buckets)
        out[b] = math.floor(SCALE * math.log(up / down))
    return out


def noise(doc_id: object, seed: int = SEED) -> int:
    """Gumbel noise of a document, in thousandths, from nothing but its id; no id counts as an empty one."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-SCALE * math.log(-math.log((h + 0.5) / 4294967296)))


def _scored(batches: Iterator[pa.RecordBatch], gain: np.ndarray, grams: int, seed: int) -> Iterator[pa.RecordBatch]:
    seen = _Buckets(len(gain))
    for batch in batches:
        for piece in slices(batch, "text", TEXT_BYTES):
            n, total, words = (np.zeros(piece.num_rows, np.int64) for _ in range(3))
            for rows, sizes, counts, held in _grouped(texts_of(piece.column("text")), grams):
                np.add.at(n, rows, sizes)
                np.add.at(words, rows, counts)
                np.add.at(total, np.repeat(rows, sizes), gain[seen.of(held)])
            weight = np.where(n > 0, total // np.maximum(n, 1), 0)
            chance = np.array([noise(x, seed) for x in piece.column("doc_id").to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(words), pa.array(n), pa.array(weight), pa.array(weight + chance)],
                ["doc_id", "n_words", "n_features", "weight", "score"],
            )


def resample(
    docs: DataFrame,
    target: DataFrame,
    grams: int = GRAMS,
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every row of ``docs``; ``rank`` is null if it is not drawn.

    Of the rows with at least ``least_words`` words, ``percent`` of a hundred are
    drawn (rounded down), highest scores first, ties to the smaller doc_id, rows
    without an id last; rows of one id and score in order of weight and number of
    features.  A null text is empty: no features, weight 0, never drawn while
    ``least_words`` is over 0.  Repeated rows are rows of their own.  An empty
    ``docs`` gives no rows, an empty ``target`` gains from its absence.  Other
    columns are ignored.

    The table of gains has ``buckets`` entries whatever the input, so the driver
    makes it from two lists of that length and every task has it.  Each text is
    read twice, for the counts and for the score.
    """
    text = F.col("text").cast("string").alias("text")
    have = {r.bucket: r.n for r in bucket_counts(docs, grams, buckets).collect()}
    want = {r.bucket: r.n for r in bucket_counts(target, grams, buckets).collect()}
    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", text).mapInArrow(
        partial(_scored, gain=gains(have, want, buckets), grams=grams, seed=seed),
        f"doc_id {kind}, n_words long, n_features long, weight long, score long",
    )
    scored = stored(scored, "importance").withColumn("eligible", F.col("n_words") >= least_words)
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("weight"), F.asc("n_features")]
    placed = in_order(scored, "eligible", order, "importance-order")
    drawn = F.col("eligible") & F.expr(f"position < members * {int(percent)} div 100")
    return placed.select(
        "doc_id", "n_words", "n_features", "weight", "score", F.when(drawn, F.col("position") + 1).alias("rank")
    )


def drawn(docs: DataFrame, target: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` whose doc_id is drawn, each id once in the list of the drawn; rows without id are left out."""
    chosen = resample(docs, target, **settings).filter("rank is not null and doc_id is not null")
    return docs.join(chosen.select("doc_id").distinct(), "doc_id", "left_semi")
