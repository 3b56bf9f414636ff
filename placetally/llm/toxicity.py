"""Toxicity by compression distance: zstandard dictionaries of toxic and of ordinary text, compared window by window."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property, partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placetally.llm.common import slices, texts_of

WINDOW_BYTES = 48
DICTIONARY_BYTES = 4096
TEXT_BYTES = 4 << 20
# Bounds of the labelled sample that a model is fitted on: documents of each class, and characters of each.
SAMPLE_DOCS = 4_000
SAMPLE_CHARS = 50_000
# A gram is toxic if it is in that share of toxic documents, and so many times likelier there than in ordinary ones.
GRAM = 5
GRAM_SHARE = 0.01
GRAM_LEAST = 5
GRAM_ODDS = 40
# The least savings in bytes that a window is counted for.
SAVINGS = (2, 3, 4)


def windows(text: bytes, size: int = WINDOW_BYTES) -> list[bytes]:
    """The whole text in lower case as runs of words of at least ``size`` bytes (the last one may be shorter).

    Each starts and ends with a blank, so that a word looks the same wherever it stands.
    """
    out, run, held = [], [], 0
    for word in text.lower().split():
        run.append(word)
        held += len(word) + 1
        if held >= size:
            out.append(b" ".join([b"", *run, b""]))
            run, held = [], 0
    if run:
        out.append(b" ".join([b"", *run, b""]))
    return out


def _grams(text: bytes) -> set[bytes]:
    out = set()
    for word in set(text.lower().split()):
        word = b" " + word
        out.update(word[i:i + GRAM] for i in range(len(word) - GRAM + 1))
    return out


def _toxic_words(toxic: list[bytes], ordinary: list[bytes]) -> list[bytes]:
    """Whole words with a blank on both sides, the most frequent first: those that ordinary text does without."""
    there, elsewhere = Counter(), Counter()
    for text in toxic:
        there.update(set(text.lower().split()))
    for text in ordinary:
        elsewhere.update(set(text.lower().split()))
    least = max(GRAM_LEAST, GRAM_SHARE * len(toxic))
    odds = GRAM_ODDS * len(toxic) / max(len(ordinary), 1)
    contexts = {w: set() for w, n in there.items() if n >= least and n > odds * (elsewhere[w] + 0.5)}
    # copies of one document say the same once: what counts is between how many different words a word stands
    for text in toxic:
        words = [b"", *text.lower().split(), b""]
        for before, word, after in zip(words, words[1:], words[2:]):
            if word in contexts:
                contexts[word].add((before, after))
    marked = [(len(c), w) for w, c in contexts.items() if len(c) >= least and len(c) > odds * (elsewhere[w] + 0.5)]
    return [b" " + w + b" " for _, w in sorted(marked, key=lambda x: (-x[0], x[1]))]


def _halves(word: bytes) -> tuple[bytes, bytes]:
    """Beginning and end of a word.  They stand in both dictionaries, so that only the whole word tells them apart."""
    n = -(-len(word) * 2 // 3)
    return word[:n], word[-n:]


def _toxic_entries(toxic: list[bytes], ordinary: list[bytes]) -> list[bytes]:
    """Pieces of words for the toxic dictionary, the most frequent first: those that ordinary text does without."""
    there, elsewhere = Counter(), Counter()
    for text in toxic:
        there.update(_grams(text))
    for text in ordinary:
        elsewhere.update(_grams(text))
    least = max(GRAM_LEAST, GRAM_SHARE * len(toxic))
    odds = GRAM_ODDS * len(toxic) / max(len(ordinary), 1)
    marked = {g for g, n in there.items() if n >= least and n > odds * (elsewhere[g] + 0.5)}
    pieces = Counter()
    for text in toxic:
        for word in text.lower().split():
            word = b" " + word
            hit = [i for i in range(len(word) - GRAM + 1) if word[i:i + GRAM] in marked]
            if hit:
                pieces[word[hit[0]:hit[-1] + GRAM]] += 1
    covered, out = set(), []
    for piece, _ in sorted(pieces.items(), key=lambda x: (-x[1], x[0])):
        own = {piece[i:i + GRAM] for i in range(len(piece) - GRAM + 1)} & marked
        if own - covered:
            out.append(piece)
            covered |= own
    return out


def _ordinary_dictionary(texts: list[bytes], size: int) -> bytes:
    samples = [w for text in texts for w in windows(text)]
    if len(samples) > 40_000:
        samples = [samples[i] for i in np.random.default_rng(0).choice(len(samples), 40_000, replace=False)]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the text itself is the dictionary
        return b"".join(samples)[:size]


@dataclass
class Model:
    """Two dictionaries and the weights that turn savings into a score."""

    ordinary: bytes
    toxic: bytes
    weights: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    @cached_property
    def _compressors(self):
        def of(content: bytes):
            # every place of a dictionary is searched, so that one more dictionary only adds matches
            how = zstandard.ZstdCompressionParameters(
                compression_level=1, window_log=17, hash_log=16, chain_log=16, search_log=5, min_match=GRAM,
                target_length=64, strategy=zstandard.STRATEGY_LAZY2,
                write_content_size=0, write_checksum=0, write_dict_id=0,
            )
            if len(content) < 8:
                return zstandard.ZstdCompressor(compression_params=how).compress
            data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(compression_params=how)
            return zstandard.ZstdCompressor(dict_data=data, compression_params=how).compress

        return of(self.ordinary), of(self.toxic + self.ordinary)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_compressors"}

    def features(self, text: bytes) -> np.ndarray:
        """Largest saving of a window, how many windows save so many bytes, and how many windows there are."""
        plain, marked = self._compressors
        saved = np.array([len(plain(w)) - len(marked(w)) for w in windows(text)] or [0])
        return np.array([
            min(max(saved.max(), 0), 12), *(np.log1p((saved >= n).sum()) for n in SAVINGS), np.log1p(len(saved)),
        ])

    def scores(self, texts: Iterable[bytes]) -> np.ndarray:
        x = np.array([self.features(t) for t in texts]).reshape(-1, len(SAVINGS) + 2)
        z = np.column_stack([np.ones(len(x)), (x - self.mean) / self.scale]) @ self.weights
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    penalty = np.diag([1e-6, *[ridge] * (x.shape[1] - 1)])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(texts: list[bytes], labels: list[int]) -> Model:
    """A model from labelled texts.  Without texts of both classes every score is the share of toxic ones, 0 to 0.25."""
    y = np.array(labels, float)
    toxic = [t for t, label in zip(texts, labels) if label]
    ordinary = [t for t, label in zip(texts, labels) if not label]
    base = _ordinary_dictionary(ordinary, DICTIONARY_BYTES)
    pieces = _toxic_entries(toxic, ordinary)
    # a word that has a piece is told by it already
    words = [w for w in _toxic_words(toxic, ordinary) if not any(p in w for p in pieces)]
    base = b"\0".join([*(half for w in words for half in _halves(w)), base])
    marked = b"\0".join([*[*words, *pieces][::-1], b""])
    n = len(SAVINGS) + 2
    model = Model(base, marked, np.zeros(n + 1), np.zeros(n), np.ones(n))
    if not toxic or not ordinary:
        model.weights[0] = np.log(1 / 3) if toxic else -30
        return model
    x = np.array([model.features(t) for t in texts])
    model.mean, model.scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    model.weights = _logistic((x - model.mean) / model.scale, y)
    return model


def held_out(doc_id: str) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def fit_on(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCS, chars: int = SAMPLE_CHARS) -> Model:
    """A model from a bounded sample of the labelled documents that are not held out.

    Of each class the ``sample`` documents with the least hash of their id, and
    of each at most ``chars`` characters.  Rows without id, text or label are
    left out; a document that is labelled both ways is toxic.
    """
    known = labels.select(F.col("doc_id").alias("of"), F.col("toxic").cast("int").alias("toxic"))
    known = known.filter("of is not null and toxic in (0, 1)").filter(~held_out("of"))
    known = known.groupBy("of").agg(F.max("toxic").alias("toxic"))
    some = None
    for label in (0, 1):
        part = known.filter(F.col("toxic") == label).orderBy(F.xxhash64("of"), "of").limit(sample)
        some = part if some is None else some.union(part)
    some = some.persist()  # a few thousand ids
    if some.count() == 0:
        return fit([], [])
    rows = (
        docs.select("doc_id", F.col("text").cast("string").alias("text")).filter("text is not null")
        .join(F.broadcast(some), F.col("doc_id") == F.col("of"))
        .select("doc_id", "toxic", F.substring("text", 1, chars).alias("text"))
        .dropDuplicates(["doc_id"]).orderBy("doc_id").collect()
    )
    some.unpersist()
    return fit([r["text"].encode() for r in rows], [r["toxic"] for r in rows])


def _scored(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch, "text", TEXT_BYTES):
            scores = pa.array(model.scores(texts_of(piece.column("text"))), pa.float64())
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), scores], ["doc_id", "score"])


def _harmless(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch, "text", TEXT_BYTES):
            yield piece.filter(pa.array(model.scores(texts_of(piece.column("text"))) < 0.5))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``, from its whole text; null is an empty text."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        partial(_scored, model=model), f"doc_id {kind}, score double"
    )
    return scored.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """``docs``, with all columns, without those that score 0.5 or more."""
    return docs.mapInArrow(partial(_harmless, model=model), docs.schema)
