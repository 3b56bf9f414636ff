import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from placetally.llm import piece_encoding as pe
from tests.llm.tables import awkward, documents

PATH = public_tokenizers.path(pe.MODEL)


@pytest.fixture(scope="module")
def model():
    return pe.read_model(PATH)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def texts():
    rng = random.Random(1)
    processor = sentencepiece.SentencePieceProcessor(model_file=PATH)
    pieces = [processor.id_to_piece(i) for i in range(259, processor.vocab_size())]
    yield from ["", " ", "▁", " ▁ x", "\n", "a\nb\n\n", "<s> </s> <unk> <0x41>", "é", "�", "\x00", "😀😀 日本語 ok", "x" * 3_000]
    for n in range(0, 70, 3):
        yield from (" " * n, "a" + " " * n + "b", " " * n + "\n" + " " * (n // 2) + "c")
    for k in range(3_000):
        if k % 3 == 0:
            yield "".join(rng.choice("ab eto\n\t éß▁日😀\x00") for _ in range(rng.randint(1, 40)))
        else:
            x = "".join(rng.choice(pieces if k % 3 == 1 else pieces[:600]) for _ in range(rng.randint(1, 15)))
            yield x.replace("▁", " ") if k % 2 else x
    yield "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(50_000))


def test_encoding_and_decoding_equal_the_library(model, library):
    for text in texts():
        ids = pe.encode(model, text)
        assert ids == library.encode(text), text[:80]
        assert pe.decode(model, ids) == library.decode(ids), text[:80]


def test_unfinished_bytes_decode_as_the_library_does(model, library):
    words = pe.encoder(model)
    rng = random.Random(2)
    for raw in (b"\xff", b"\xe6\x97", b"\xe6\x97A", b"\xf0\x9f\x98\x80\x80", *(rng.randbytes(rng.randint(1, 6)) for _ in range(300))):
        ids = [words.bytes[b] for b in raw]
        assert pe.decode(model, [library.piece_to_id("▁a"), *ids]) == library.decode([library.piece_to_id("▁a"), *ids]), raw


def test_tables(spark, model, library, monkeypatch):
    docs = awkward(spark, random.Random(3), [(30 + i, t) for i, t in enumerate(texts()) if i % 10 == 0 and "\x00" not in t])

    def want(text):
        ids = library.encode(text or "")
        return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()

    expected = sorted(((r.doc_id, *want(r.text)) for r in docs.collect()), key=repr)
    assert sorted(map(tuple, pe.piece_digest(docs, model).collect()), key=repr) == expected
    encoded = pe.encode_documents(docs, model)
    assert sorted((r.doc_id or -1, len(r.ids)) for r in encoded.collect()) == sorted((r[0] or -1, r[1]) for r in expected)
    back = pe.decode_documents(encoded, model).filter("doc_id = 7").first()
    assert back.text == docs.filter("doc_id = 7").first().text
    assert pe.piece_digest(docs.limit(0), model).count() == 0


def test_small_memory_and_parts_change_nothing(model, library, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(pe, "REMEMBERED", 50)
    monkeypatch.setattr(pe, "PART_CHARS", 40)
    monkeypatch.setattr(pe, "TOGETHER", 30)
    pe._memory.cache_clear()
    held = [t for i, t in enumerate(texts()) if i % 7 == 0 and len(t) < 5_000]
    held += [" ".join(held)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(held))), pa.array(held)], ["doc_id", "text"])
    got = [r["ids_sha256"] for out in pe._digests(iter([batch]), model) for r in out.to_pylist()]
    assert got == [hashlib.sha256(",".join(map(str, library.encode(t))).encode()).hexdigest() for t in held]
    pe._memory.cache_clear()


def test_other_models_are_refused(model):
    with pytest.raises(ValueError):
        pe.vocabulary(model[:-30])
