"""Removal of word sequences that an earlier document has: trees of suffixes, split by prefixes into bounded groups.

A suffix matters only down to the depth of a window (13 words), so the trees end there: a node at that depth is a word
sequence, its leaves are the places where the sequence starts, and a node with leaves in several documents is a repeat.
Suffixes are dealt over groups by a short key of their window.  Sorting a group by the path of each suffix puts the
leaves of a node side by side.

* Short key: the five words of the window whose hash is least.  Neighbouring suffixes mostly share it, so they travel
  as one run, about 36 bytes for 5 suffixes.
* Variable length: keys of many documents are extended to the whole window.  What is still equal then is one node.
* A batch of documents sends each window once, for its smallest document; later documents of the batch are settled on
  the spot.  A passage that a third of all documents share is thereby one suffix a batch.

Paths are compared as hashes: 32 bits of key and 40 bits of window, besides the bits that choose the group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placetally.llm.common import fresh, mixed, replaced, slices, stored, texts_of
from placetally.llm.wordhash import gram_hashes, sliding_least, word_hashes

WINDOW = 13
KEY_WORDS = 5
TEXT_BYTES = 1 << 19
BATCH_WORDS = 250_000
GROUP_BYTES = 2 << 20
# A key is extended if it is in more than this share of the documents.  The share is looked up in every 32nd document;
# it decides where suffixes meet, not what is found, and bounds the list of keys by (keys a document) / share.
EXTEND_SHARE = 1e-4
EXTEND_LEAST = 8
EXTEND_EVERY = 32
SEED = 42

LEAVES = "bucket long, rows binary, run_row binary, run_start binary, run_size binary, keys binary, paths binary"
SPANS = "doc_id long, text_hash long, spans binary"


class _Batch:
    """Windows of a number of documents: key and path of each, in order of document and place."""

    def __init__(self, ids: list[int], texts: list[bytes], words: np.ndarray, counts: np.ndarray, window: int):
        self.ids = np.array(ids, np.int64)
        self.hashes = np.array([xxhash.xxh64_intdigest(x, SEED) for x in texts], np.uint64).view(np.int64)
        n = np.maximum(counts - window + 1, 0)
        first = np.cumsum(counts) - counts
        self.row = np.repeat(np.arange(len(ids)), n)
        self.start = np.arange(len(self.row)) - np.repeat(np.cumsum(n) - n, n)
        at = self.start + first[self.row]
        least = sliding_least(gram_hashes(words, KEY_WORDS), window - KEY_WORDS + 1)
        self.key = least[at]
        self.path = gram_hashes(words, window)[at]


def _batches(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[_Batch]:
    ids: list[int] = []
    texts: list[bytes] = []
    words: list[np.ndarray] = []
    counts: list[np.ndarray] = []
    held = 0
    for batch in batches:
        for piece in slices(batch, "text", TEXT_BYTES):
            new = texts_of(piece.column("text"))
            h, n = word_hashes(new)
            ids += piece.column("doc_id").to_pylist()
            texts += new
            words.append(h)
            counts.append(n)
            held += len(h)
            if held >= BATCH_WORDS:
                yield _Batch(ids, texts, np.concatenate(words), np.concatenate(counts), window)
                ids, texts, words, counts, held = [], [], [], [], 0
    if ids:
        yield _Batch(ids, texts, np.concatenate(words), np.concatenate(counts), window)


def _spans(rows: np.ndarray, starts: np.ndarray, window: int, ids: np.ndarray, hashes: np.ndarray) -> pa.RecordBatch:
    """Word spans (from, to) that windows cover, one row per document row.  Sorted by row and start."""
    new = np.r_[True, (rows[1:] != rows[:-1]) | (starts[1:] > starts[:-1] + window)]
    head = np.flatnonzero(new)
    last = np.r_[head[1:], len(rows)] - 1
    pairs = np.stack([starts[head], starts[last] + window], axis=1).astype(np.uint32)
    row = rows[head]
    edges = np.r_[np.flatnonzero(np.r_[True, row[1:] != row[:-1]]), len(row)]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids[row[edges[:-1]]]), pa.array(hashes[row[edges[:-1]]]),
            pa.array([pairs[a:b].tobytes() for a, b in zip(edges, edges[1:])], pa.binary()),
        ],
        ["doc_id", "text_hash", "spans"],
    )


def _later(path: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Whether a smaller document has the same path."""
    order = np.argsort(path)
    sorted_path = path[order]
    new = np.r_[True, sorted_path[1:] != sorted_path[:-1]]
    least = np.minimum.reduceat(doc[order], np.flatnonzero(new))
    out = np.empty(len(path), bool)
    out[order] = doc[order] > least[np.cumsum(new) - 1]
    return out


def _leaves(batches: Iterator[pa.RecordBatch], window: int, groups: int, long_keys: np.ndarray):
    for b in _batches(batches, window):
        if not len(b.path):
            continue
        settled = _later(b.path, b.ids[b.row])
        if settled.any():
            done = _spans(b.row[settled], b.start[settled], window, b.ids, b.hashes)
            n = done.num_rows
            rows = np.stack([done.column(0).to_numpy(), done.column(1).to_numpy()], axis=1)
            empty = pa.array([b""] * n, pa.binary())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array((mixed(rows[:, 1]) % np.uint64(groups)).view(np.int64)),
                    pa.array([r.tobytes() for r in rows], pa.binary()), empty, done.column(2), empty, empty, empty,
                ],
                [x.split()[0] for x in LEAVES.split(", ")],
            )
        open_ = ~settled
        row, start, key, path = b.row[open_], b.start[open_], b.key[open_], b.path[open_]
        far = np.isin(key, long_keys)
        run = np.r_[True, (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1) | (key[1:] != key[:-1])] | far | (start % 128 == 0)
        head = np.flatnonzero(run)
        size = np.diff(np.r_[head, len(row)])
        bucket = mixed(np.where(far[head], key[head] ^ path[head], key[head])) % np.uint64(groups)
        order = np.argsort(bucket, kind="stable")
        head, size, bucket = head[order], size[order], bucket[order]
        at = np.repeat(head - (np.cumsum(size) - size), size) + np.arange(size.sum())
        octets = path[at].view(np.uint8).reshape(-1, 8)[:, :5]
        ends = np.cumsum(size)
        edges = np.r_[np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]), len(bucket)]
        parts: list[list] = [[] for _ in range(7)]
        for x, y in zip(edges, edges[1:]):
            known, which = np.unique(row[head[x:y]], return_inverse=True)
            parts[0].append(int(bucket[x]))
            parts[1].append(np.stack([b.ids[known], b.hashes[known]], axis=1).tobytes())
            parts[2].append(which.astype(np.uint16 if len(known) <= 1 << 16 else np.uint32).tobytes())
            parts[3].append(start[head[x:y]].astype(np.uint32).tobytes())
            parts[4].append(size[x:y].astype(np.uint8).tobytes())
            parts[5].append(key[head[x:y]].astype(np.uint32).tobytes())
            parts[6].append(octets[ends[x - 1] if x else 0:ends[y - 1]].tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(parts[0], pa.int64()), *(pa.array(p, pa.binary()) for p in parts[1:])],
            [x.split()[0] for x in LEAVES.split(", ")],
        )


def _nodes(group: pa.Table, window: int) -> pa.Table:
    """Spans of the suffixes of a group whose node has a leaf in a smaller document."""
    out, rows, row, start, size, key, octets, known = [], [], [], [], [], [], [], 0
    done: list[tuple[int, int, bytes]] = []
    for x in group.select([n.split()[0] for n in LEAVES.split(", ")[1:]]).to_batches():
        for r, i, s, n, k, p in zip(*(c.to_pylist() for c in x.columns)):
            pairs = np.frombuffer(r, np.int64).reshape(-1, 2)
            if not k:
                done.append((int(pairs[0, 0]), int(pairs[0, 1]), s))
                continue
            rows.append(pairs)
            row.append(np.frombuffer(i, np.uint16 if len(i) == 2 * len(n) else np.uint32).astype(np.int64) + known)
            start.append(np.frombuffer(s, np.uint32))
            size.append(np.frombuffer(n, np.uint8))
            key.append(np.frombuffer(k, np.uint32))
            octets.append(np.frombuffer(p, np.uint8).reshape(-1, 5))
            known += len(pairs)
    if rows:
        all_rows = np.concatenate(rows)
        n = np.concatenate(size).astype(np.int64)
        at = np.repeat(np.arange(len(n)), n)
        place = np.concatenate(start).astype(np.int64)[at] + np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
        low = np.zeros((len(at), 8), np.uint8)
        low[:, :5] = np.concatenate(octets)
        path = mixed(np.concatenate(key)[at].astype(np.uint64) ^ mixed(low.view(np.uint64).ravel()))
        owner = np.concatenate(row)[at]
        later = _later(path, all_rows[owner, 0])
        if later.any():
            owner, place = owner[later], place[later]
            order = np.lexsort((place, owner))
            out.append(_spans(owner[order], place[order], window, all_rows[:, 0], all_rows[:, 1]))
    if done:
        out.append(pa.RecordBatch.from_arrays(
            [pa.array([d[0] for d in done]), pa.array([d[1] for d in done]), pa.array([d[2] for d in done], pa.binary())],
            ["doc_id", "text_hash", "spans"],
        ))
    names = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("spans", pa.binary())])
    return pa.Table.from_batches(out, names)


def _keys(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for b in _batches(batches, window):
        pairs = np.unique(np.stack([b.row.astype(np.uint64), b.key], axis=1), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 1].view(np.int64))], ["key"])


def long_keys(docs: DataFrame, window: int) -> np.ndarray:
    """Keys in more than ``EXTEND_SHARE`` of the documents, as every ``EXTEND_EVERY``-th document shows them."""
    some = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(EXTEND_EVERY)) == 0)
    least = max(EXTEND_LEAST, int(some.count() * EXTEND_SHARE))
    counted = some.mapInArrow(partial(_keys, window=window), "key long").groupBy("key").count()
    return np.array([r["key"] for r in counted.filter(F.col("count") >= least).collect()], np.int64).view(np.uint64)


def repeated_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text_hash, spans): words covered by windows that also start in a document with a smaller doc_id.

    ``spans`` are little-endian uint32 pairs (from, to) of word places; a
    document may have several rows, and their spans may overlap.  ``text_hash``
    tells apart rows of one doc_id with different texts (XXH64, seed 42).
    Texts without a full window, null texts and rows without doc_id have none.
    """
    some = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    some = some.filter("doc_id is not null and text is not null")
    size = some.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    leaves = some.mapInArrow(
        partial(_leaves, window=window, groups=-(-size // GROUP_BYTES) or 1, long_keys=long_keys(some, window)), LEAVES
    )

    def nodes(group: pa.Table) -> pa.Table:
        return _nodes(group, window)

    return leaves.groupBy("bucket").applyInArrow(nodes, SPANS)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for spans in batch.column("found").to_pylist():
            pairs = np.frombuffer(b"".join(spans), np.uint32).reshape(-1, 2).astype(np.int64)
            pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
            reach = np.maximum.accumulate(pairs[:, 1])
            head = np.flatnonzero(np.r_[True, pairs[1:, 0] > reach[:-1]])
            out.append(list(zip(pairs[head, 0].tolist(), reach[np.r_[head[1:], len(pairs)] - 1].tolist())))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_hash"), pa.array(out, pa.list_(pa.list_(pa.int64())))],
            ["doc_id", "text_hash", "repeats"],
        )


def maximal_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text_hash, repeats) of the documents that repeat an earlier one.

    ``repeats`` are disjoint word spans (from, to) in order: what overlapping or
    adjoining windows cover together.  See ``repeated_spans`` for the cases.
    """
    found = repeated_spans(docs, window).groupBy("doc_id", "text_hash").agg(F.collect_list("spans").alias("found"))
    return found.mapInArrow(_joined, "doc_id long, text_hash long, repeats array<array<long>>")


def _without(text: bytes, spans: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    words = text.split()
    change = np.zeros(len(words) + 1, np.int64)
    for s in spans:
        pairs = np.frombuffer(s, np.uint32).reshape(-1, 2)
        np.add.at(change, pairs[:, 0], 1)
        np.add.at(change, pairs[:, 1], -1)
    return words, np.cumsum(change[:-1]) == 0


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch, "text", TEXT_BYTES):
            total, removed, digest = [], [], []
            for text, spans in zip(texts_of(piece.column("text")), piece.column("found").to_pylist()):
                words, keep = _without(text, spans or [])
                rest = words if keep.all() else [w for w, k in zip(words, keep.tolist()) if k]
                total.append(len(words))
                removed.append(len(words) - len(rest))
                digest.append(hashlib.sha256(b" ".join(rest)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest)],
                ["doc_id", "n_words", "n_removed", "kept_sha256"],
            )


def _shortened(batches: Iterator[pa.RecordBatch], found: str, n_chars: str | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch, "text", TEXT_BYTES):
            all_spans = piece.column(found).to_pylist()
            piece = piece.drop_columns([found])
            texts, lengths, stay = [], piece.column(n_chars).to_pylist() if n_chars else [], []
            for i, (text, spans) in enumerate(zip(piece.column("text").to_pylist(), all_spans)):
                if spans:
                    words, keep = _without(text.encode(), spans)
                    text = b" ".join(w for w, k in zip(words, keep.tolist()) if k).decode()
                    if n_chars:
                        lengths[i] = len(text)
                stay.append(text != "" or not spans)
                texts.append(text)
            piece = replaced(piece, "text", pa.array(texts, piece.schema.field("text").type))
            if n_chars:
                piece = replaced(piece, n_chars, pa.array(lengths, piece.schema.field(n_chars).type))
            yield piece.filter(pa.array(stay, pa.bool_()))


def _with_spans(docs: DataFrame, columns: list[str], window: int) -> tuple[DataFrame, str]:
    """The columns of ``docs`` and one more with the spans of each row, and its name."""
    found, key, of = (fresh(n, docs.columns) for n in ("found", "text_hash", "found_id"))
    spans = stored(repeated_spans(docs, window), "spans")
    spans = spans.groupBy(F.col("doc_id").alias(of), F.col("text_hash").alias(key)).agg(F.collect_list("spans").alias(found))
    on = (F.col("doc_id").cast("long") == F.col(of)) & (F.xxhash64(F.col("text").cast("string")) == F.col(key))
    return docs.select(*columns).join(spans, on, "left").select(*columns, found), found


def substring_digest(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row of ``docs``.

    ``kept_sha256`` is of the kept words, joined by one space.  A null text has
    no words.  Rows that repeat a doc_id do not count as earlier than each
    other; a row without doc_id loses nothing and takes nothing away.
    """
    joined, _ = _with_spans(docs.select("doc_id", F.col("text").cast("string").alias("text")), ["doc_id", "text"], window)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(_digests, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string")


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with the repeated words taken out of ``text``; texts that lose nothing keep their white space.

    A document that loses all its words goes.  ``n_chars``, where there is such
    a column, follows the new text.  Other columns stay as they are.
    """
    joined, found = _with_spans(docs, docs.columns, window)
    n_chars = "n_chars" if "n_chars" in docs.columns else None
    return joined.mapInArrow(partial(_shortened, found=found, n_chars=n_chars), docs.schema)
