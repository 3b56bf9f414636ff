"""Numbers of word pieces by greedy longest match, with an automaton that never builds the pieces.

The automaton is a trie of the vocabulary.  A node without the wanted continuation has a failure link: it pops the pieces
that greedy matching is sure of by then, whose number is precomputed, and goes on at the rest.  A word takes time in
proportion to its length.  The different words of a batch walk side by side.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placetally.llm.common import slices, texts_of

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
TEXT_BYTES = 4 << 20


def read_vocabulary(path: str) -> list[bytes]:
    """Pieces of a file with a base64 piece and its rank on each line; the driver reads it."""
    with open(path, "rb") as lines:
        return [base64.b64decode(line.split()[0]) for line in lines if line.strip()]


class Automaton:
    """Trie with failure links; ``popped`` is the number of pieces that a failure settles."""

    def __init__(self, vocabulary: Iterable[bytes]):
        children: list[dict[int, int]] = [{}]
        final = [False]
        for piece in vocabulary:
            at = 0
            for byte in piece:
                node = children[at].get(byte)
                if node is None:
                    node = children[at][byte] = len(children)
                    children.append({})
                    final.append(False)
                at = node
            final[at] = final[at] or at > 0
        fail, popped = [-1] * len(children), [0] * len(children)
        level = [0]
        while level:
            following = []
            for u in level:
                for byte, v in children[u].items():
                    following.append(v)
                    if final[v]:
                        fail[v], popped[v] = 0, 1
                        continue
                    z, n = fail[u], popped[u]
                    while z >= 0 and byte not in children[z]:
                        n += popped[z]
                        z = fail[z]
                    if z >= 0:
                        fail[v], popped[v] = children[z][byte], n
            level = following
        keys = [(u << 8 | byte, v) for u, own in enumerate(children) for byte, v in own.items()]
        keys.sort()
        self.edges = np.array([k for k, _ in keys], np.int64)
        self.targets = np.array([v for _, v in keys], np.int32)
        self.fail = np.array(fail, np.int32)
        self.popped = np.array(popped, np.int32)
        self.root = np.full(256, -1, np.int32)
        for byte, v in children[0].items():
            self.root[byte] = v

    def _next(self, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
        out = self.root[byte]
        deep = np.flatnonzero(state > 0)
        if len(deep) and len(self.edges):
            key = state[deep].astype(np.int64) << 8 | byte[deep]
            at = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
            out[deep] = np.where(self.edges[at] == key, self.targets[at], -1)
        return out

    def count(self, words: list[bytes]) -> np.ndarray:
        """Pieces of each word; 1 for a word that cannot be split into pieces (unknown), 0 for an empty one."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(-lengths, kind="stable")
        lengths = lengths[order]
        total = np.zeros(len(words), np.int64)
        lost = np.zeros(len(words), bool)
        state = np.zeros(len(words), np.int32)
        data = np.frombuffer(b"".join(words[i] for i in order), np.uint8)
        first = np.cumsum(lengths) - lengths
        for k in range(int(lengths[0]) if len(words) else 0):
            live = int(np.searchsorted(-lengths, -k, side="left"))  # words longer than k
            at = np.flatnonzero(~lost[:live])
            byte = data[first[at] + k]
            step = self._next(state[at], byte)
            miss = np.flatnonzero(step < 0)
            while len(miss):
                own = at[miss]
                total[own] += self.popped[state[own]]
                state[own] = self.fail[state[own]]
                gone = state[own] < 0
                lost[own[gone]] = True
                miss = miss[~gone]
                step[miss] = self._next(state[at[miss]], byte[miss])
                miss = miss[step[miss] < 0]
            state[at] = step
        at = np.flatnonzero(~lost & (state > 0))
        while len(at):
            total[at] += self.popped[state[at]]
            state[at] = self.fail[state[at]]
            lost[at[state[at] < 0]] = True
            at = at[state[at] > 0]
        total[lost] = 1
        out = np.empty_like(total)
        out[order] = total
        return out


def _counted(batches: Iterator[pa.RecordBatch], automaton, prefix: bytes) -> Iterator[pa.RecordBatch]:
    machine = automaton.value
    for batch in batches:
        for piece in slices(batch, "text", TEXT_BYTES):
            known: dict[bytes, int] = {}
            parts, sizes = [], []
            for text in texts_of(piece.column("text")):
                words = text.split()
                parts.append(np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words)))
                sizes.append(len(words))
            each = machine.count([prefix + w for w in known])
            tokens = [int(each[p].sum()) for p in parts]
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64())],
                ["doc_id", "n_words", "n_tokens"],
            )


def count_tokens(docs: DataFrame, vocabulary: Iterable[bytes], prefix: bytes = b" ") -> DataFrame:
    """(doc_id, n_words, n_tokens) of every row of ``docs``.

    Words are runs of anything but ASCII white space.  Each, with ``prefix``
    before it, is split into the longest pieces of the vocabulary from left to
    right; a word that this cannot split is one unknown piece.  A null or blank
    text has no words.  The automaton is sent to the executors once; it grows
    with the vocabulary, not with the documents.
    """
    automaton = docs.sparkSession.sparkContext.broadcast(Automaton(vocabulary))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        partial(_counted, automaton=automaton, prefix=prefix), f"doc_id {kind}, n_words long, n_tokens long"
    )
