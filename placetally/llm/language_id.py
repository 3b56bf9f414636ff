"""Language identification by error-correcting output codes.

Every language has a codeword of bits.  One classifier over hashed byte n-grams answers for each bit; the language whose
codeword loses least against the answers, weighed by how sure they are, is chosen, so a few wrong bits do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placetally.llm.common import slices, stored, texts_of

UNKNOWN = "und"
# Bits of a codeword: at least so many, and so many for each doubling of the languages, to keep codewords apart.
BITS = 24
BITS_PER_DOUBLING = 6
# A list of chosen ids of up to this size is broadcast; an id takes so many bytes besides its text.
BROADCAST_BYTES = 32 << 20
ID_BYTES = 40
DIMENSIONS = 1 << 13
TEXT_BYTES = 1 << 20
# Bounds of the labelled sample: documents of each language, and characters of each document.
SAMPLE_DOCS = 600
SAMPLE_CHARS = 4_000
ROUNDS = 200
# A document is ambiguous if the two best languages are nearer than this share of the largest possible loss.
MARGIN = 0.05
_LETTER = regex.compile(r"\p{L}")
_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[65:91] += 32
# blanks, digits and ASCII punctuation are all one kind of gap
_LOWER[[b for b in range(128) if not (65 <= b <= 90 or 97 <= b <= 122)]] = 32
_ORDERS = (1, 2, 3, 4)


def counts_of(texts: list[bytes]) -> np.ndarray:
    """Shares of hashed n-grams of 1 to 4 bytes of each whole text; square roots, so that long texts weigh no more."""
    out = np.zeros((len(texts), DIMENSIONS), np.float32)
    for row, text in enumerate(texts):
        total = np.zeros(DIMENSIONS)
        for k in range(0, max(len(text), 1), TEXT_BYTES):
            data = _LOWER[np.frombuffer(b" " + text[k:k + TEXT_BYTES + 3] + b" ", np.uint8)]
            blank = data == 32
            data = data[~(blank & np.r_[False, blank[:-1]])]
            h = np.zeros(len(data), np.uint32)
            for n in _ORDERS:
                if len(data) < n:
                    break
                h = h[: len(data) - n + 1] * np.uint32(0x01000193) ^ data[n - 1:]
                spread = (h * np.uint32(0x9E3779B1) + np.uint32(n * 0x85EBCA6B & 0xFFFFFFFF)) >> np.uint32(19)
                total += np.bincount(spread, minlength=DIMENSIONS)
        out[row] = np.sqrt(total / max(total.sum(), 1))
    return out


def codewords(n: int, bits: int = BITS) -> np.ndarray:
    """``n`` codewords of +1 and -1, far apart: the farthest of random codes whose columns are not constant."""
    chance = np.random.default_rng(5)
    best, far = np.ones((n, bits)), -1
    if n < 2:
        return best
    for _ in range(200):
        code = chance.choice([-1.0, 1.0], (n, bits))
        flat = np.abs(code.sum(axis=0)) == n
        code[0, flat] *= -1
        apart = (bits - code @ code.T) / 2 + np.eye(n) * bits
        if apart.min() > far:
            best, far = code, apart.min()
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray

    def decode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the nearest codeword, a score of 0 to 1, and whether the choice is ambiguous."""
        x = counts_of(texts)
        answers = x @ self.weights[:-1] + self.weights[-1]
        # logistic loss of each answer against each codeword; unsure answers weigh little
        loss = np.logaddexp(0, -answers[:, None, :] * self.code[None, :, :]).sum(axis=2)
        near = np.exp(-(loss - loss.min(axis=1, keepdims=True)) / 4)
        score = near.max(axis=1) / near.sum(axis=1)
        order = np.sort(loss, axis=1)
        gap = order[:, 1] - order[:, 0] if loss.shape[1] > 1 else np.full(len(x), np.inf)
        return loss.argmin(axis=1), score, gap < MARGIN * np.abs(answers).sum(axis=1)


def _train_bits(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Weights of logistic classifiers for all columns of ``y`` (+1, -1) by gradient steps with momentum."""
    x = np.column_stack([x, np.ones(len(x), np.float32)])
    w = np.zeros((x.shape[1], y.shape[1]), np.float32)
    move = np.zeros_like(w)
    for _ in range(rounds):
        grad = -x.T @ (y / (1 + np.exp(np.clip(y * (x @ w), -30, 30)))) / len(x) + 1e-6 * w
        move = 0.9 * move - 20.0 * grad.astype(np.float32)
        w += move
    return w


def held_out(doc_id: str) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def _least(batches: Iterator[pa.RecordBatch], sample: int) -> Iterator[pa.RecordBatch]:
    """The ``sample`` rows of least hash of each language in a task; the others can't be among the least of all."""
    held = None
    for batch in batches:
        held = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
        held = held.group_by(["lang", "h", "doc_id"]).aggregate([])  # a repeated document is one
        held = held.sort_by([("lang", "ascending"), ("h", "ascending"), ("doc_id", "ascending")])
        lang = held.column("lang").combine_chunks().dictionary_encode().indices.to_numpy()
        first = np.flatnonzero(np.r_[True, lang[1:] != lang[:-1]]) if len(lang) else np.zeros(0, np.int64)
        rank = np.arange(len(lang)) - np.repeat(first, np.diff(np.r_[first, len(lang)]))
        held = held.filter(pa.array(rank < sample)).combine_chunks()
    if held is not None:
        yield from held.to_batches(max_chunksize=1_000)


def sample_of(docs: DataFrame, sample: int = SAMPLE_DOCS, chars: int = SAMPLE_CHARS) -> DataFrame:
    """(lang, h, doc_id, text): of each language the ``sample`` documents with the least hash of their id.

    Of each document ``chars`` characters from a place that the hash picks.
    Every task hands on its own least rows, without texts, so none receives the
    rows of a frequent language.  Texts stay where they are; only those of the
    sample move.  Of several texts with one id the one of least hash counts.
    Documents that are held out, and those without id, language or text, are left
    out.
    """
    known = docs.select(
        "doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")
    ).filter("lang is not null and text is not null and doc_id is not null").filter(~held_out("doc_id"))
    known = known.withColumn("h", F.xxhash64("doc_id", F.lit(3)))
    ids = known.select("lang", "h", "doc_id")
    ranked = ids.mapInArrow(partial(_least, sample=sample), ids.schema).distinct().withColumn(
        "n", F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id"))
    ).filter(F.col("n") <= sample)
    chosen = stored(ranked.select("lang", "h", "doc_id"), "language_sample")
    # The list has ``sample`` ids for each language; only a measured, small one is broadcast.
    size = chosen.agg(F.coalesce(F.sum(F.octet_length("lang") + F.octet_length(F.col("doc_id").cast("string")) + ID_BYTES), F.lit(0)))
    if size.first()[0] <= BROADCAST_BYTES:
        chosen = F.broadcast(chosen)
    start = F.floor(F.pmod("h", F.lit(1_000_000)) / 1_000_000 * F.greatest(F.length("text") - chars, F.lit(0))).cast("int") + 1
    text = F.struct(F.xxhash64("text").alias("of_text"), F.substring("text", start, F.lit(chars)).alias("text"))
    cut = known.join(chosen, ["lang", "h", "doc_id"]).select("lang", "h", "doc_id", text.alias("cut"))
    least = cut.groupBy("lang", "h", "doc_id").agg(F.min("cut").alias("cut"))
    return least.select("lang", "h", "doc_id", "cut.text").orderBy("h", "doc_id", "lang")


def bits_for(languages: int) -> int:
    return max(BITS, BITS_PER_DOUBLING * (max(languages, 1) - 1).bit_length())


def fit_on(docs: DataFrame, sample: int = SAMPLE_DOCS, chars: int = SAMPLE_CHARS, bits: int | None = None) -> Model:
    """A model from a bounded sample of documents with a language that are not held out.

    See ``sample_of`` for the sample.  Bits are trained by four tasks; their
    number grows with the logarithm of the number of languages.
    """
    rows = sample_of(docs, sample, chars).collect()
    languages = sorted({r["lang"] for r in rows})
    bits = bits or bits_for(len(languages))
    if not languages:
        return Model([], np.zeros((0, bits)), np.zeros((DIMENSIONS + 1, bits), np.float32))
    place = {lang: i for i, lang in enumerate(languages)}
    texts, labels = [r["text"].encode() for r in rows], [place[r["lang"]] for r in rows]
    code = codewords(len(languages), bits)
    return Model(languages, code, _fit_bits(docs, texts, code[labels]))


def _fit_bits(docs: DataFrame, texts: list[bytes], y: np.ndarray) -> np.ndarray:
    spark = docs.sparkSession
    x = spark.sparkContext.broadcast((texts, y))
    bits = y.shape[1]
    groups = 4

    def train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, answers = x.value
        for batch in batches:
            for group in batch["id"]:
                own = list(range(group, bits, groups))
                w = _train_bits(counts_of(known), answers[:, own].astype(np.float32))
                yield pd.DataFrame({"bit": own, "weights": [w[:, k].tolist() for k in range(len(own))]})

    found = spark.range(0, groups, 1, groups).mapInPandas(train, "bit long, weights array<float>").collect()
    out = np.zeros((DIMENSIONS + 1, bits), np.float32)
    for r in found:
        out[:, r["bit"]] = r["weights"]
    return out


def _identified(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            for piece in slices(batch.slice(start, 256), "text", TEXT_BYTES):
                texts = texts_of(piece.column("text"))
                language, score, ambiguous = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
                at = [i for i, t in enumerate(texts) if _LETTER.search(t.decode())]
                if at and model.languages:
                    best, sure, close = model.decode([texts[i] for i in at])
                    score[at], ambiguous[at] = sure, close
                    for i, k in zip(at, best.tolist()):
                        language[i] = model.languages[k]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array(language), pa.array(score), pa.array(ambiguous)],
                    ["doc_id", "lang_pred", "score", "ambiguous"],
                )


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, ambiguous) of every row of ``docs``, from its whole text.

    Null texts, texts without a letter, and all texts of a model without
    languages are ``und`` with score 0.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        partial(_identified, model=model), f"doc_id {kind}, lang_pred string, score double, ambiguous boolean"
    )
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", "ambiguous")
