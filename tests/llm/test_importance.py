import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from placetally.llm import importance
from placetally.llm.crc import ROW, crc32_of
from tests.conftest import rows
from tests.llm.tables import awkward, documents, prose


def test_crc_equals_the_library():
    rng = np.random.default_rng(1)
    words = {rng.bytes(int(n)) for n in [0, 1, 1, 2, 3, 3, 7, 40, 40, ROW - 1, ROW, 2 * ROW, 2 * ROW + 1, 5 * ROW, 7 * ROW + 13, 300_000]}
    assert crc32_of(words) == {w: zlib.crc32(w) for w in words}


def by_rule(docs, target, grams=1, buckets=10_000, least=20, percent=10):
    def features(text):
        words = re.findall(rb"[a-z0-9\x80-\xff]+", "".join(c.lower() if c < "\x80" else c for c in text or "").encode())
        return words, [b" ".join(words[i:i + n]) for n in range(1, grams + 1) for i in range(len(words) - n + 1)]

    def bucket(f):
        return zlib.crc32(f) % buckets

    s, t = (Counter(bucket(f) for _, text in side for f in features(text)[1]) for side in (docs, target))
    big_s, big_t = sum(s.values()), sum(t.values())
    out = []
    for doc_id, text in docs:
        words, own = features(text)
        gains = [math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))) for b in map(bucket, own)]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(words), len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0], r[3], r[2]))
    for k in range(len(able) * percent // 100):
        able[k][5] = k + 1
    return sorted(map(tuple, out), key=repr)


@pytest.mark.parametrize("grams, buckets", [(1, 10_000), (3, 50)])
def test_draws_by_rule(spark, grams, buckets):
    rng = random.Random(2)
    docs = awkward(spark, rng, [(100 + i, prose(rng, rng.randint(0, 60)).title() + " Ünï-code 7") for i in range(300)])
    target = documents(spark, [(i, prose(rng, 20)) for i in range(20)] + [(99, None)])
    got = rows(importance.resample(docs, target, grams, buckets, percent=25))
    pairs = [[(r.doc_id, r.text) for r in side.collect()] for side in (docs, target)]
    assert got == by_rule(*pairs, grams, buckets, percent=25)
    kept = importance.drawn(docs, target, grams=grams, buckets=buckets, percent=25)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r[0] for r in got if r[5] and r[0] is not None}


def test_long_texts_in_parts(spark, monkeypatch):
    monkeypatch.setattr(importance, "TEXT_BYTES", 64)
    text = prose(random.Random(3), 200).encode()
    parts = list(importance.words_in_parts(text, 2))
    assert len(parts) > 10 and parts[0] + [w for p in parts[1:] for w in p[2:]] == text.split()
    runs, carried = [], 0
    for part in parts:
        runs += importance._features(part, 3, carried)
        carried = min(len(part), 2)
    words = text.split()
    assert Counter(runs) == Counter(b" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1))


def test_empty_tables(spark):
    docs = documents(spark, [(1, prose(random.Random(4), 30))])
    assert importance.resample(docs.limit(0), docs).count() == 0
    assert rows(importance.resample(docs, docs.limit(0), percent=100))[0][5] == 1
