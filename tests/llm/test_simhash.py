import random

import numpy as np
import xxhash

from placetally.llm import simhash
from placetally.llm.components import connected_components, forest
from tests.conftest import rows
from tests.llm.tables import awkward, documents, prose


def by_rule(text, n=3):
    words = (text or "").encode().lower().split()
    runs = [b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or ([b" ".join(words)] if words else [])
    total = [sum(xxhash.xxh64_intdigest(r, 42) >> bit & 1 for r in runs) for bit in range(64)]
    return sum(1 << bit for bit in range(64) if 2 * total[bit] > len(runs))


def components_by_rule(bits, links):
    label = list(range(len(bits)))
    for i, j in links:
        a, b = sorted((label[i], label[j]))
        label = [a if x == b else x for x in label]
    return label


def test_fingerprints_equal_the_rule(spark):
    rng = random.Random(1)
    texts = [None, "", "A", "b A", "a b c", "A B C d", prose(rng, 700), " x É é\x1fz\x0bq"]
    got = simhash.simhash(documents(spark, list(enumerate(texts)))).collect()
    assert {r.doc_id: r.bits & (1 << 64) - 1 for r in got} == {i: by_rule(t) for i, t in enumerate(texts)}


def test_ball_links_find_all_pairs_within_three(spark):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    bits = list(base)
    for x in base:
        for places in ([0, 3, 6], [1, 4, 61], [5], [2, 63], [0, 1, 2, 3], *(rng.choice(64, rng.integers(1, 5), replace=False) for _ in range(12))):
            bits.append(x ^ np.bitwise_or.reduce(np.uint64(1) << np.array(places, np.uint64)))
    bits = np.unique(np.array(bits, np.uint64))
    df = spark.createDataFrame([(int(b),) for b in bits.view(np.int64)], "bits long")
    links = simhash.ball_links(df).collect()
    apart = np.bitwise_count(bits[:, None] ^ bits[None, :])
    x, y = np.nonzero((apart <= 3) & (apart > 0))
    want = dict(zip(*forest(bits.view(np.int64)[x], bits.view(np.int64)[y])))
    got = dict(zip(*forest(np.array([r.a for r in links]), np.array([r.b for r in links]))))
    assert got == want


def test_components_of_a_long_path_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(0, 300)] + [(1_000, 1_000 + i) for i in range(1, 400)] + [(5, None), (7, 7)]
    got = dict(rows(connected_components(spark.createDataFrame(edges, "a long, b long").repartition(7))))
    assert got == {i: 0 for i in range(301)} | {1_000 + i: 1_000 for i in range(400)}


def test_awkward_documents(spark):
    rng = random.Random(3)
    text = prose(rng, 200)
    docs = awkward(spark, rng, [(20, text), (21, text.upper()), (22, text)])
    found = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert {(20, 20), (21, 20), (22, 20), (2, 2), (3, 2), (4, 2), (1, 1)} <= found
    assert simhash.near_duplicates(docs).count() == docs.count()
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.filter("doc_id is not null").collect()) == [1, 1, 2, 5, 6, 7, 8, 20]
    none = docs.limit(0)
    assert simhash.near_duplicates(none).count() == simhash.keep_first(none).count() == 0
