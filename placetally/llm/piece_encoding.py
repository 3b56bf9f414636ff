"""SentencePiece encoding and decoding of merge-type (BPE) models by backtracking.

The pieces of a text are those that merging the best adjacent pair, again and
again, would leave.  They are found without merging: from the left, the longest
piece is taken (Aho-Corasick gives it for every position), and it stays if it is
compatible with the piece before, that is, if merging the characters of the two
gives these two again.  Otherwise the next shorter piece is tried; if none is
left, the position has failed, is marked in a bitfield, and the piece before it
gives way.  No position is tried again once it has failed, so the time is linear
in the text.
"""

from __future__ import annotations

import hashlib
import re
import struct
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placetally.llm.common import slices

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
BPE = 2
TEXT_BYTES = 2 << 20
# Chunks that a worker remembers, and the longest chunk that it does remember.
REMEMBERED = 800_000
REMEMBERED_CHARS = 64
# Characters of a text that are cut into chunks at a time, and chunks that are looked up together.
PART_CHARS = 1 << 20
TOGETHER = 1 << 17


# --- model file -----------------------------------------------------------------------------------------------------


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbered fields of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(key & 7)
        size = varint() if size is None else size
        yield key >> 3, data[at:at + size]
        at += size


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with score and kind, and what is done to a text before it is cut."""

    pieces: tuple[tuple[str, float, int], ...]
    dummy_prefix: bool


def read_model(path: str) -> bytes:
    """The model file, read by the driver; it travels to the tasks with the job."""
    with open(path, "rb") as file:
        return file.read()


def vocabulary(model: bytes) -> Vocabulary:
    """Vocabulary of a merge-type model with identity normalisation; anything else is refused."""
    pieces, kind, prefix, squeeze, escape, charsmap, suffix = [], 1, True, True, True, b"", False
    for field, value in _fields(model):
        if field == 1:
            entry = dict(_fields(value))
            score = struct.unpack("<f", entry[2])[0] if 2 in entry else 0.0
            pieces.append((entry.get(1, b"").decode(), score, entry.get(3, NORMAL)))
        elif field == 2:
            spec = dict(_fields(value))
            kind, suffix = spec.get(3, 1), bool(spec.get(24, 0))
        elif field == 3:
            spec = dict(_fields(value))
            charsmap, prefix, squeeze, escape = spec.get(2, b""), spec.get(3, 1), spec.get(4, 1), spec.get(5, 1)
    if kind != BPE or charsmap or squeeze or not escape or suffix:
        raise ValueError("only merge-type models that keep the text as it is are supported")
    if {k for _, _, k in pieces} - {NORMAL, UNKNOWN, CONTROL, BYTE} or sum(k == BYTE for _, _, k in pieces) != 256:
        raise ValueError("the model needs all byte pieces and no user-defined or unused ones")
    return Vocabulary(tuple(pieces), bool(prefix))


# --- encoding -------------------------------------------------------------------------------------------------------


class Encoder:
    """Exact encoding with a vocabulary: ids of a chunk of text, found by backtracking."""

    def __init__(self, words: Vocabulary):
        self.pieces = [p for p, _, _ in words.pieces]
        self.scores = {p: s for p, s, k in words.pieces if k == NORMAL}
        ids = {p: i for i, (p, _, k) in enumerate(words.pieces) if k == NORMAL}
        if any(c not in ids for p in ids for c in p):
            raise ValueError("every character of a piece must be a piece")
        self.bytes = [0] * 256
        self.byte_of = {}
        for i, (p, _, k) in enumerate(words.pieces):
            if k == BYTE:
                self.bytes[int(p[3:5], 16)] = i
                self.byte_of[i] = int(p[3:5], 16)
        self.dummy_prefix = words.dummy_prefix
        # a piece that merging its characters does not give is never used
        self.ids = {p: i for p, i in ids.items() if len(p) == 1 or self._merged(p) == [p]}
        self.size = len(self.pieces)
        self.shorter = [-1] * self.size
        for p, i in self.ids.items():
            for n in range(len(p) - 1, 0, -1):
                if p[:n] in self.ids:
                    self.shorter[i] = self.ids[p[:n]]
                    break
        self.length = [len(p) for p in self.pieces]
        # pieces backwards: what ends where, read from the right, is what starts there
        self.automaton = ahocorasick.Automaton()
        for p, i in self.ids.items():
            self.automaton.add_word(p[::-1], i)
        self.automaton.make_automaton()
        self.fits: dict[int, bool] = {}
        self.texts = [str(i) for i in range(self.size)]
        self.cut, self.edge = self._cuts()

    def _cuts(self) -> tuple[re.Pattern, re.Pattern | None]:
        """Pattern of a chunk, and of a place where a long text may be parted.

        Merges stay inside a chunk, because no piece reaches over its ends: apart
        from space signs, which only lead a piece, characters that never stand
        side by side in a piece are in different chunks.
        """
        pairs = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)}
        if any(a != SPACE == b for a, b in pairs):
            return re.compile("(?s).+"), None
        group: dict[str, set[str]] = {}
        for a, b in pairs:
            if SPACE not in (a, b):
                one, other = group.get(a, {a}), group.get(b, {b})
                if one is not other:
                    for c in other:
                        one.add(c)
                    for c in one:
                        group[c] = one
        classes = {id(g): "[" + "".join(map(re.escape, sorted(g))) + "]+" for g in group.values()}
        kinds = "|".join([*classes.values(), f"[^{SPACE}]"])
        return re.compile(f"(?s){SPACE}*(?:{kinds})|{SPACE}+"), re.compile(f"(?s)[^{SPACE}](?={SPACE})")

    def _merged(self, text: str) -> list[str]:
        """Characters of a short text after merging the best pair, the leftmost of equals, until none is left."""
        parts, scores = list(text), self.scores
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging the characters of two neighbours gives the two again."""
        key = a * self.size + b
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) > 4 * REMEMBERED:
                self.fits.clear()
            x, y = self.pieces[a], self.pieces[b]
            known = self.fits[key] = x + y not in self.scores and self._merged(x + y) == [x, y]
        return known

    def longest(self, text: str) -> array:
        """Id of the longest piece that starts at each position, -1 where none does."""
        best = array("i", [-1]) * len(text)
        last, before = len(text) - 1, -1
        for end, piece in self.automaton.iter(text[::-1]):
            if end != before:  # of the pieces that end here the longest comes first
                best[last - end] = piece
                before = end
        return best

    def encode(self, text: str, best: array | None = None, start: int = 0, stop: int | None = None) -> list[int]:
        """Ids of ``text[start:stop]``, which already has its space signs."""
        best = self.longest(text) if best is None else best
        stop = len(text) if stop is None else stop
        out: list[int] = []
        failed: bytearray | None = None  # made when the first position fails
        length, shorter, known, size = self.length, self.shorter, self.fits.get, self.size
        at, settled = start, 0
        piece = best[at] if at < stop else -1
        while at < stop:
            if len(out) > settled:
                before = out[-1]
                while piece >= 0:
                    fit = known(before * size + piece)
                    if self.compatible(before, piece) if fit is None else fit:
                        end = at + length[piece] - start
                        if failed is None or not failed[end >> 3] >> (end & 7) & 1:
                            break
                    piece = shorter[piece]
            elif piece >= 0:
                end = at + length[piece] - start
                while failed is not None and piece >= 0 and failed[end >> 3] >> (end & 7) & 1:
                    piece = shorter[piece]
                    end = at + length[piece] - start
            else:
                # a character in no piece: its bytes, and nothing merges over it
                out.extend([self.bytes[x] for x in text[at].encode()])
                at += 1
                settled = len(out)
                piece = best[at] if at < stop else -1
                continue
            if piece >= 0:
                out.append(piece)
                at += length[piece]
                piece = best[at] if at < stop else -1
                if piece < 0:
                    settled = len(out)
            else:
                failed = failed or bytearray((stop - start) // 8 + 1)
                failed[(at - start) >> 3] |= 1 << ((at - start) & 7)
                piece = out.pop()
                at -= length[piece]
        return out

    def encode_all(self, chunks: list[str]) -> list[list[int]]:
        """Ids of each chunk; one pass of the automaton over all of them."""
        joined = [c for c in chunks if "\n" not in c] if "\n" not in self.ids else []
        text = "\n".join(joined)
        best, found, at = self.longest(text), {}, 0
        for chunk in joined:
            found[chunk] = self.encode(text, best, at, at + len(chunk))
            at += len(chunk) + 1
        return [found[c] if c in found else self.encode(c) for c in chunks]

    def surface(self, ids: list[int]) -> str:
        """Text of ids as decoding gives it, but for the space in front of a whole text."""
        if self.byte_of.keys().isdisjoint(ids):
            pieces = self.pieces
            return "".join([pieces[i] for i in ids]).replace(SPACE, " ")
        out, pending = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                pending.append(self.byte_of[i])
                continue
            if pending:
                out.append(_from_bytes(bytes(pending)))
                pending.clear()
            out.append(self.pieces[i])
        if pending:
            out.append(_from_bytes(bytes(pending)))
        return "".join(out).replace(SPACE, " ")

    def chunks(self, text: str) -> Iterator[list[str]]:
        """Chunks of a text, with space signs; a long text comes in parts."""
        marked = text.replace(" ", SPACE)
        if self.dummy_prefix and marked:
            marked = SPACE + marked
        at = 0
        while at < len(marked):
            edge = self.edge and self.edge.search(marked, at + PART_CHARS)
            end = edge.end() if edge else len(marked)
            yield self.cut.findall(marked, at, end)
            at = end


def _from_bytes(raw: bytes) -> str:
    """Text of byte pieces; each byte that is no part of a character becomes a replacement sign."""
    out, at = [], 0
    while at < len(raw):
        for n in (1, 2, 3, 4):
            try:
                out.append(raw[at:at + n].decode())
            except UnicodeDecodeError:
                continue
            at += n
            break
        else:
            out.append("�")
            at += 1
    return "".join(out)


@lru_cache(maxsize=4)
def encoder(model: bytes) -> Encoder:
    """The encoder of a model file, built once in each Python worker."""
    return Encoder(vocabulary(model))


def encode(model: bytes, text: str | None) -> list[int]:
    """Ids of one whole text, null being empty."""
    words = encoder(model)
    return [i for window in words.chunks(text or "") for ids in words.encode_all(window) for i in ids]


def decode(model: bytes, ids: Iterable[int]) -> str:
    """Text of ids from ``encode``."""
    words = encoder(model)
    text = words.surface(list(ids))
    return text[1:] if words.dummy_prefix and text.startswith(" ") else text


# --- tables ---------------------------------------------------------------------------------------------------------


class _Memory:
    """Ids of chunks, as text, and what they decode to where that is not the chunk itself."""

    def __init__(self, words: Encoder):
        self.words, self.known, self.odd = words, {}, {}

    def of(self, chunks: set[str]) -> tuple[dict[str, str], dict[str, str]]:
        """Ids of all the chunks, perhaps of others too, and their decoded texts; new ones are encoded side by side."""
        new = chunks.difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:
            self.known, self.odd, new = {}, {}, chunks
        brief = [c for c in new if len(c) <= REMEMBERED_CHARS]
        self._take(brief, self.words.encode_all(brief), self.known, self.odd)
        if len(brief) == len(new):
            return self.known, self.odd
        long = [c for c in new if len(c) > REMEMBERED_CHARS]
        known, odd = {c: self.known[c] for c in chunks.intersection(self.known)}, dict(self.odd)
        self._take(long, map(self.words.encode, long), known, odd)
        return known, odd

    def _take(self, chunks: list[str], coded: Iterable[list[int]], known: dict[str, str], odd: dict[str, str]) -> None:
        texts = self.words.texts
        for chunk, ids in zip(chunks, coded):
            known[chunk] = ",".join([texts[i] for i in ids])
            surface = self.words.surface(ids)
            if surface != chunk.replace(SPACE, " "):
                odd[chunk] = surface


@lru_cache(maxsize=4)
def _memory(model: bytes) -> _Memory:
    return _Memory(encoder(model))


class _Digest:
    """Running digests of one text."""

    def __init__(self):
        self.n, self.ids, self.text, self.empty = 0, hashlib.sha256(), hashlib.sha256(), True

    def add(self, ids: str, surface: str, prefix: bool) -> None:
        if not self.empty:
            self.ids.update(b",")
        elif prefix and surface.startswith(" "):
            surface = surface[1:]
        self.n += ids.count(",") + 1
        self.ids.update(ids.encode())
        self.text.update(surface.encode())
        self.empty = False


def _digests(batches: Iterator[pa.RecordBatch], model: bytes) -> Iterator[pa.RecordBatch]:
    memory = _memory(model)
    prefix = memory.words.dummy_prefix

    def settle(waiting: list[tuple[_Digest, list[str]]]) -> None:
        known, odd = memory.of(set().union(*[chunks for _, chunks in waiting]))
        for digest, chunks in waiting:
            decoded = [odd.get(c, c) for c in chunks] if odd else chunks
            digest.add(",".join(map(known.__getitem__, chunks)), "".join(decoded).replace(SPACE, " "), prefix)
        waiting.clear()

    for batch in batches:
        for piece in slices(batch, "text", TEXT_BYTES):
            digests, waiting, held = [], [], 0
            for text in piece.column("text").to_pylist():
                digests.append(_Digest())
                for chunks in memory.words.chunks(text or ""):
                    waiting.append((digests[-1], chunks))
                    held += len(chunks)
                    if held >= TOGETHER:
                        settle(waiting)
                        held = 0
            settle(waiting)
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"), pa.array([d.n for d in digests], pa.int64()),
                    pa.array([d.ids.hexdigest() for d in digests]), pa.array([d.text.hexdigest() for d in digests]),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )


def _encoded(batches: Iterator[pa.RecordBatch], model: bytes) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch, "text", TEXT_BYTES):
            ids = [encode(model, x) for x in piece.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"]
            )


def _decoded(batches: Iterator[pa.RecordBatch], model: bytes) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [decode(model, x or []) for x in batch.column("ids").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.col("text").cast("string").alias("text"))


def _id_type(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def encode_documents(docs: DataFrame, model: bytes) -> DataFrame:
    """(doc_id, ids): the pieces of every whole text, without begin or end signs.

    A null text is empty and has no ids; rows stay as they are, repeated ones and
    ones without doc_id included.  Other columns are ignored.
    """
    return _texts(docs).mapInArrow(partial(_encoded, model=model), f"doc_id {_id_type(docs)}, ids array<int>")


def decode_documents(encoded: DataFrame, model: bytes) -> DataFrame:
    """(doc_id, text) of (doc_id, ids); no ids give an empty text."""
    rows = encoded.select("doc_id", F.col("ids").cast("array<int>").alias("ids"))
    return rows.mapInArrow(partial(_decoded, model=model), f"doc_id {_id_type(encoded)}, text string")


def piece_digest(docs: DataFrame, model: bytes) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row, by encoding and decoding chunk by chunk.

    Same rules as ``encode_documents`` and ``decode_documents``; a text of any
    length passes in windows of chunks, so that only one very long run without
    spaces is held with its positions as a whole.
    """
    return _texts(docs).mapInArrow(
        partial(_digests, model=model),
        f"doc_id {_id_type(docs)}, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )
