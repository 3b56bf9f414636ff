"""SimHash near-duplicates by ball hashing that meets in the middle."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placetally.llm.common import mixed, slices, stored, texts_of
from placetally.llm.components import connected_components, forest

SEED = 42
RADIUS = 3
MASKS = 3
TEXT_BYTES = 1 << 21
SHINGLES_AT_ONCE = 1 << 18
ROWS_PER_TASK = 1_000_000


# --- fingerprints ---------------------------------------------------------------------------------------------------


def _hashes(text: bytes, shingle: int) -> np.ndarray:
    """XXH64 of each run of ``shingle`` words; of the whole sequence if it is shorter."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[:-shingle] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1:].tolist())], np.uint64)


def _ones(hashes: np.ndarray) -> np.ndarray:
    """How often each bit is set, the highest bit first."""
    total = np.zeros(64, np.int64)
    for k in range(0, len(hashes), SHINGLES_AT_ONCE):
        octets = hashes[k:k + SHINGLES_AT_ONCE].astype(">u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(octets, axis=1).sum(axis=0, dtype=np.int64)
    return total


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """Fingerprint as an unsigned number: a bit is set if it is set in over half the shingle hashes; no words: 0."""
    hashes = _hashes(text, shingle)
    if not len(hashes):
        return 0
    return int.from_bytes(np.packbits(2 * _ones(hashes) > len(hashes)).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch, "text", TEXT_BYTES):
            bits = [fingerprint(x, shingle) for x in texts_of(piece.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(np.array(bits, np.uint64).view(np.int64))], ["doc_id", "bits"]
            )


def simhash(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, bits): the 64-bit SimHash of every whole text; a null or blank text has 0.

    A-Z are lower-cased, words are runs of anything but ASCII white space, and
    every repeated shingle counts again.  Other columns of ``docs`` are ignored.
    """
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        partial(_fingerprints, shingle=shingle), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, bits long"
    )


# --- ball hashing ---------------------------------------------------------------------------------------------------
#
# A radius of 3 is odd, so half of it is no whole number.  One difference is taken up by a mask: the 64 bits fall into
# three masks, and for each of them a fingerprint emits its unmasked bits and all variants of these within distance 1.
# Two fingerprints with differences under a mask and at most two outside meet on a variant of the outside bits.  The
# masks take turns, so that every pair within distance 3 meets; see _links.


def mask_bits(mask: int) -> list[int]:
    return [bit for bit in range(64) if bit % MASKS == mask]


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(mask, place, variant, bits): 131 variants of each fingerprint; ``place`` is the hash of what must meet."""
    for batch in batches:
        for k in range(0, batch.num_rows, 2_000):
            bits = batch.column("bits").to_numpy()[k:k + 2_000].view(np.uint64)
            for mask in range(MASKS):
                inside = np.bitwise_or.reduce([np.uint64(1) << np.uint64(b) for b in mask_bits(mask)])
                flips = [0, *(1 << b for b in range(64) if b % MASKS != mask)]
                variant = (bits[:, None] ^ np.array(flips, np.uint64)[None, :]).ravel()
                place = mixed((variant & ~inside) ^ np.uint64(mask))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(place.view(np.int64)), pa.array(variant.view(np.int64)),
                        pa.array(np.repeat(bits, len(flips)).view(np.int64)),
                        pa.array(np.full(len(variant), mask, np.int8)),
                    ],
                    ["place", "variant", "bits", "mask"],
                )


def _links(place: np.ndarray, variant: np.ndarray, bits: np.ndarray, mask: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among rows of one mask, enough to connect all pairs that meet here within distance 3, and no others.

    Rows of one variant are within distance 2: one star.  Two variants that
    differ in one masked bit belong to fingerprints within distance 3: their
    first rows are linked.  Differences that all lie under the mask are compared
    among fingerprints whose outside bits are equal.
    """
    order = np.lexsort((bits, variant, place))
    place, variant, bits = place[order], variant[order], bits[order]
    # places that only one fingerprint has reached are of no use
    new = np.r_[True, place[1:] != place[:-1]]
    group = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    low, high = np.minimum.reduceat(bits, first), np.maximum.reduceat(bits, first)
    keep = (low != high)[group]
    variant, bits = variant[keep], bits[keep]
    if not len(bits):
        return bits, bits
    order = np.lexsort((bits, variant))
    variant, bits = variant[order], bits[order]
    new = np.r_[True, variant[1:] != variant[:-1]]
    head = np.flatnonzero(new)
    a, b = [bits], [bits[head[np.cumsum(new) - 1]]]
    known, lead = variant[head], bits[head]
    for bit in mask_bits(mask):
        other = known ^ (np.uint64(1) << np.uint64(bit))
        at = np.minimum(np.searchsorted(known, other), len(known) - 1)
        hit = known[at] == other
        a.append(lead[hit])
        b.append(lead[at[hit]])
    own = np.unique(bits[variant == bits])
    x, y = _within_mask(own, mask)
    a, b = np.concatenate([*a, x]), np.concatenate([*b, y])
    differ = a != b
    a, b = a[differ], b[differ]
    near = np.bitwise_count(a ^ b) <= RADIUS
    return a[near], b[near]


def _within_mask(own: np.ndarray, mask: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that differ in exactly three masked bits: those one and two flips away meet."""
    places = mask_bits(mask)
    inside = np.bitwise_or.reduce([np.uint64(1) << np.uint64(b) for b in places])
    outside = own & ~inside
    order = np.argsort(outside, kind="stable")
    own, outside = own[order], outside[order]
    new = np.r_[True, outside[1:] != outside[:-1]] if len(own) else np.zeros(0, bool)
    size = np.bincount(np.cumsum(new) - 1) if len(own) else np.zeros(0, np.int64)
    own = np.sort(own[np.repeat(size, size) > 1])
    a, b = [own[:0]], [own[:0]]
    if len(own):
        flips = [np.uint64(1) << np.uint64(x) for x in places]
        for i, x in enumerate(flips):
            for j in range(i + 1, len(flips)):
                for z in flips[j + 1:]:
                    other = own ^ (x | flips[j] | z)
                    at = np.minimum(np.searchsorted(own, other), len(own) - 1)
                    hit = own[at] == other
                    if hit.any():
                        a.append(own[hit])
                        b.append(own[at[hit]])
    return np.concatenate(a), np.concatenate(b)


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [
        [batch.column(name).to_numpy() for name in ("place", "variant", "bits", "mask")] for batch in batches
    ]
    if not held:
        return
    place, variant, bits, masks = (np.concatenate(x) for x in zip(*held))
    for mask in range(MASKS):
        of = masks == mask
        if of.any():
            a, b = _links(*(x[of].view(np.uint64) for x in (place, variant, bits)), mask)
            a, b = forest(a.view(np.int64), b.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def ball_links(fingerprints: DataFrame) -> DataFrame:
    """(a, b): edges that connect the values of ``bits`` within distance 3 of each other, and no others.

    A task turns the links it finds into stars, so an edge may join two values
    that are linked over others.

    ``fingerprints`` holds each value once.  131 variants a value are dealt by
    the unmasked bits; a task holds about a million of them, and no group is
    larger than the values that agree in 42 bits up to one flip.
    """
    spread = -(-fingerprints.count() * (64 * (MASKS - 1) + MASKS) // ROWS_PER_TASK)
    return (
        fingerprints.select("bits").mapInArrow(_variants, "place long, variant long, bits long, mask byte")
        .repartition(max(1, spread), "place").mapInArrow(_meet, "a long, b long")
    )


def near_duplicates(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, bits, component_id): documents linked by fingerprints with at most 3 differing bits.

    ``component_id`` is the smallest doc_id reachable by links, itself included.
    Equal fingerprints are one node from the start, however many documents have
    them.  Null, empty and blank texts have fingerprint 0 and are linked like
    any other.  Repeated rows stay repeated; a null doc_id never names a
    component unless no other document is in it.  An empty table gives no rows.
    """
    marked = stored(simhash(docs, shingle), "simhash")
    values = stored(marked.groupBy("bits").agg(F.min("doc_id").alias("first_id")), "simhash-values")
    reached = connected_components(ball_links(values))
    roots = values.join(reached.withColumnRenamed("node", "bits"), "bits", "left").select(
        "bits", "first_id", F.coalesce("component", "bits").alias("root")
    )
    least = roots.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = roots.join(least, "root").select("bits", "component_id")
    return marked.join(named, "bits").select("doc_id", "bits", "component_id")


def hex_digits(bits: str) -> Column:
    return F.lower(F.lpad(F.hex(bits), 16, "0"))


def keep_first(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """The documents without the later members of each group of near-duplicates.

    Rows that repeat a doc_id are one document: they stay or go together.
    """
    last = near_duplicates(docs, shingle).filter("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(last, "doc_id", "left_anti")
