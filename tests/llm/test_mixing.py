import random
from collections import defaultdict

import numpy as np
import pytest

from placetally.llm import mixing
from tests.llm.tables import awkward, documents, prose


def shares(sizes):
    """Targets as the rule tells them: shared by weight, what is above a cap is shared again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, rest, open_ = dict.fromkeys(names, 0.0), 1.5 * sum(sizes.values()), set(names)
    while rest > 1e-9 and open_:
        whole = sum(weight[s] for s in open_)
        given = {s: rest * weight[s] / whole for s in open_}
        rest = 0.0
        for s, g in given.items():
            target[s] += g
            if target[s] >= 2 * sizes[s]:
                rest += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
                open_.discard(s)
    return target


@pytest.mark.parametrize("group_rows", [7, 4_096])
def test_mix_is_near_its_targets(spark, monkeypatch, group_rows):
    monkeypatch.setattr(mixing, "GROUP_ROWS", group_rows)
    monkeypatch.setattr(mixing, "FAN_IN", 3)
    rng = random.Random(8)
    names = ["é", "a", "B", "zz", None, "b", "mid"]
    docs = documents(spark, [(i, prose(rng, rng.choice([1, 5, 20, 60])), "en", names[0] if i % 3 == 0 else rng.choice(names)) for i in range(600)])
    got = mixing.mix_sizes(docs).collect()
    source = {r.doc_id: r.source for r in docs.collect()}
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in got:
        sizes[source[r.doc_id]] += r["size"]
        taken[source[r.doc_id]] += r.taken
        assert r.taken <= 2 * r["size"] and r.taken % max(r["size"], 1) == 0
    want = shares(sizes)
    for r in got:
        assert r.source_size == sizes[source[r.doc_id]] and r.target == pytest.approx(want[source[r.doc_id]])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 60, s
    again = mixing.mix_sizes(docs.repartition(7)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_play_keeps_mass_and_expectation():
    chance = np.random.default_rng(1)
    sizes, p = np.array([7, 3, 5, 1, 9, 4]), np.array([0.3, 0.6, 0.5, 0.9, 0.2, 0.7])
    total = np.zeros(6)
    for _ in range(20_000):
        out, at = mixing.play(sizes, p, chance)
        assert out @ sizes == pytest.approx(p @ sizes) and sum(0 < x < 1 for x in out) <= 1
        total += out
    assert total / 20_000 == pytest.approx(p, abs=0.02)


def test_awkward_documents(spark):
    docs = awkward(spark, random.Random(9))
    got = mixing.mix_sizes(docs).collect()
    assert len(got) == docs.count() and {r["size"] for r in got if r.doc_id in (2, 3, 4)} == {0}
    mixed = mixing.mix(docs)
    assert mixed.columns == [*docs.columns, "_copy"] and mixed.filter("words <> 'mine' or copy <> 'mine'").count() == 0
    words = mixed.select(mixing.word_count("text").alias("n")).agg({"n": "sum"}).first()[0]
    assert words == sum(r.taken for r in got)
    assert mixing.mix_sizes(docs.limit(0)).count() == mixing.mix(docs.limit(0)).count() == 0
