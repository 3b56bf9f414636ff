"""Benchmark passages in documents, found with a positional inverted index.

The index is dealt by documents: a row holds the postings of a block of documents (terms, how often, and their places in
the block, term after term).  Only terms that the benchmark asks for get postings, so the index is a fraction of the
text.  A search intersects offset-adjusted lists within a block, from the terms that are rarest in the whole index; no
posting is shuffled, and a frequent term is never one task's work.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placetally.llm.common import replaced, slices, stored, texts_of

WINDOW = 10
TEXT_BYTES = 4 << 20
BLOCK_WORDS = 1_000_000
# A search passes this many bytes of benchmark text to the tasks at a time; a larger benchmark takes several searches.
CHUNK_BYTES = 8 << 20
# Words are runs of these bytes; all others count as blanks.
_WORD = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in bytes(range(256)).lower())

INDEX = "doc_ids array<long>, keys array<long>, lengths array<long>, terms array<binary>, counts array<long>, places binary"


def words_of(text: bytes) -> list[bytes]:
    """Words of a text: A-Z are lower-cased, all ASCII but letters and digits parts words."""
    return text.translate(_WORD).split()


def items_of(benchmark: DataFrame) -> DataFrame:
    """(item_id string, text) of the items with a text and an id, each pair once."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    return items.filter("item_id is not null and text is not null").distinct()


def _block(ids: list, keys: list[int], lengths: list[int], parts: list[np.ndarray], terms: list[bytes], gap: int) -> pa.RecordBatch:
    """One index row.  Places count the words of the block, with a gap after each document."""
    first = np.cumsum([0, *lengths[:-1]]) + gap * np.arange(len(lengths))
    code = np.concatenate(parts)
    place = np.arange(len(code)) + np.repeat(first - np.cumsum([0, *lengths[:-1]]), lengths)
    wanted = code >= 0
    code, place = code[wanted], place[wanted]
    order = np.argsort(code, kind="stable")
    count = np.bincount(code, minlength=len(terms))
    there = np.flatnonzero(count)
    row = {
        "doc_ids": [ids], "keys": [keys], "lengths": [lengths], "terms": [[terms[t] for t in there]],
        "counts": [count[there].tolist()], "places": [place[order].astype(np.uint32).tobytes()],
    }
    return pa.RecordBatch.from_pydict(row, pa.schema([
        ("doc_ids", pa.list_(pa.int64())), ("keys", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("terms", pa.list_(pa.binary())),
        ("counts", pa.list_(pa.int64())), ("places", pa.binary()),
    ]))


def _index(batches: Iterator[pa.RecordBatch], terms: list[bytes], gap: int) -> Iterator[pa.RecordBatch]:
    code = {t: i for i, t in enumerate(terms)}.get
    ids: list[int] = []
    keys: list[int] = []
    lengths: list[int] = []
    parts: list[np.ndarray] = []
    held = 0
    for batch in batches:
        for piece in slices(batch, "text", TEXT_BYTES):
            columns = (piece.column("doc_id").to_pylist(), piece.column("text_key").to_pylist(), texts_of(piece.column("text")))
            for doc, key, text in zip(*columns):
                words = words_of(text)
                parts.append(np.fromiter((code(w, -1) for w in words), np.int32, len(words)))
                ids.append(doc)
                keys.append(key)
                lengths.append(len(words))
                held += len(words)
                if held >= BLOCK_WORDS:
                    yield _block(ids, keys, lengths, parts, terms, gap)
                    ids, keys, lengths, parts, held = [], [], [], [], 0
    if ids:
        yield _block(ids, keys, lengths, parts, terms, gap)


def build_index(docs: DataFrame, terms: list[bytes], gap: int) -> DataFrame:
    """Postings of ``terms`` in every document; ``gap`` keeps matches from running over the end of a document."""
    text = F.col("text").cast("string")
    some = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    return some.mapInArrow(partial(_index, terms=terms, gap=gap), INDEX)


def _starts(places: dict[bytes, np.ndarray], phrase: tuple[bytes, ...], rank: dict[bytes, int], slop: int) -> np.ndarray:
    """Places where the phrase starts.  With slop, a word may stand up to so many places off its own."""
    found = None
    for k in sorted(range(len(phrase)), key=lambda k: rank.get(phrase[k], 0)):
        own = places.get(phrase[k])
        if own is None:
            return np.zeros(0, np.int64)
        own = own - k
        if found is None:
            found = own
            continue
        at = np.searchsorted(own, found - slop)
        at_hand = at < len(own)
        found = found[at_hand][own[at[at_hand]] <= found[at_hand] + slop]
        if not len(found):
            break
    return found


def _search(batches, phrases: list[tuple[bytes, ...]], owners: list[list[str]], rank: dict, gap: int, slop: int):
    """A row per document with its words and, where phrases occur, spans (from, to) and item ids."""
    schema = pa.schema([
        ("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_words", pa.int64()), ("spans", pa.list_(pa.list_(pa.int64()))),
        ("items", pa.list_(pa.string())),
    ])
    anchor = [min(p, key=lambda w: rank.get(w, 0)) for p in phrases]
    for batch in batches:
        for row in batch.to_pylist():
            ends = np.cumsum(row["counts"])
            flat = np.frombuffer(row["places"], np.uint32).astype(np.int64)
            places = {t: flat[e - n:e] for t, n, e in zip(row["terms"], row["counts"], ends)}
            lengths = np.array(row["lengths"], np.int64)
            first = np.cumsum(lengths) - lengths + gap * np.arange(len(lengths))
            spans: dict[int, list[tuple[int, int]]] = {}
            items: dict[int, set[str]] = {}
            for rare, phrase, owner in zip(anchor, phrases, owners):
                if rare not in places:
                    continue
                starts = _starts(places, phrase, rank, slop)
                docs = np.searchsorted(first, starts, side="right") - 1
                for d, s in zip(docs.tolist(), (starts - first[docs]).tolist()):
                    spans.setdefault(d, []).append((max(0, s - slop), min(s + len(phrase) + slop, int(lengths[d]))))
                    items.setdefault(d, set()).update(owner)
            merged = [_merged(spans.get(d, [])) for d in range(len(lengths))]
            yield pa.RecordBatch.from_pydict({
                "doc_id": row["doc_ids"], "text_key": row["keys"], "n_words": row["lengths"], "spans": merged,
                "items": [sorted(items.get(d, ())) for d in range(len(lengths))],
            }, schema)


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def phrases_of(items: list[tuple[str, str]], window: int) -> dict[tuple[bytes, ...], list[str]]:
    """Windows of the items with the ids of the items that have them; a shorter item is one window."""
    out: dict[tuple[bytes, ...], list[str]] = {}
    for item, text in items:
        words = words_of(text.encode())
        for k in range(max(len(words) - window, 0) + 1 if words else 0):
            owners = out.setdefault(tuple(words[k:k + window]), [])
            if not owners or owners[-1] != item:
                owners.append(item)
    return out


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = 0) -> DataFrame:
    """(doc_id, n_words, spans, items) of every document: where windows of benchmark items occur.

    ``spans`` are disjoint word spans (from, to), ``items`` the sorted item ids
    as strings.  ``slop`` 0 asks for exact phrases; a larger one for words up to
    that many places off (proximity).  Null and blank texts have no words and
    no matches; items without words have no windows; repeated rows stay
    repeated; an empty benchmark matches nothing.
    """
    items = items_of(benchmark)
    total = items.agg(F.sum(F.octet_length("text") + F.lit(1))).first()[0] or 0
    n = -(-total // CHUNK_BYTES) or 1
    parts = stored(items.withColumn("chunk", F.pmod(F.xxhash64("item_id", "text"), F.lit(n))), "benchmark")
    chunks = [parts.filter(F.col("chunk") == k) for k in range(n)]
    # Rows of one id and text are alike in every search: they meet as one row with a count, and part again at the end.
    key = ["doc_id", "text_key", "n_words"]
    found = None
    for chunk in chunks:
        phrases = phrases_of([(r["item_id"], r["text"]) for r in chunk.select("item_id", "text").collect()], window)
        one = _matches(docs, phrases, window, slop)
        if len(chunks) == 1:
            return one.drop("text_key")
        one = one.groupBy(key).agg(F.count("*").alias("n"), F.first("spans").alias("spans"), F.first("items").alias("items"))
        found = one if found is None else found.union(one)
    met = found.groupBy(key).agg(
        F.max("n").alias("n"), F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    met = met.mapInArrow(_disjoint, met.schema)
    return met.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), "n"))).select("doc_id", "n_words", "spans", "items")


def _disjoint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = [_merged([tuple(s) for s in x]) for x in batch.column("spans").to_pylist()]
        yield replaced(batch, "spans", pa.array(spans, pa.list_(pa.list_(pa.int64()))))


def _matches(docs: DataFrame, phrases: dict, window: int, slop: int) -> DataFrame:
    gap = window + 2 * slop + 1
    terms = sorted({w for p in phrases for w in p})
    index = stored(build_index(docs, terms, gap), "postings")
    counts = index.select(F.explode(F.arrays_zip("terms", "counts")).alias("x")).groupBy("x.terms").agg(
        F.sum("x.counts").alias("n")
    )
    rank = {bytes(r["terms"]): r["n"] for r in counts.collect()}
    keys = list(phrases)
    return index.mapInArrow(
        partial(_search, phrases=keys, owners=[phrases[k] for k in keys], rank=rank, gap=gap, slop=slop),
        "doc_id long, text_key long, n_words long, spans array<array<long>>, items array<string>",
    )


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hit = [sum(b - a for a, b in _merged([tuple(s) for s in x])) for x in batch.column("spans").to_pylist()]
        items = batch.column("items").to_pylist()
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), batch.column("n_words"), pa.array(hit, pa.int64()),
                pa.array([len(x) for x in items], pa.int64()),
                pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items], pa.string()),
                pa.array([h > 0 for h in hit], pa.bool_()),
            ],
            ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
        )


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every document; see ``matches``."""
    return matches(docs, benchmark, window).mapInArrow(
        _digest, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the documents in which a window of a benchmark item occurs; rows of one doc_id go together."""
    hit = matches(docs, benchmark, window).filter("size(spans) > 0").select("doc_id").distinct()
    return docs.join(hit, "doc_id", "left_anti")
