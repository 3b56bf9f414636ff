import random

from placetally.llm import decontamination
from tests.llm.tables import awkward, documents, prose


def words(text):
    return decontamination.words_of((text or "").encode())


def by_rule(docs, items, n=10):
    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for item, item_text in items:
            own = words(item_text)
            size = min(n, len(own))
            windows = {tuple(own[k:k + size]) for k in range(len(own) - size + 1)} if own else set()
            for k in range(len(w) - size + 1 if own else 0):
                if tuple(w[k:k + size]) in windows:
                    hit.update(range(k, k + size))
                    found.add(str(item))
        out.append((i, len(w), len(hit), ",".join(sorted(found))))
    return sorted(out, key=repr)


def result(found):
    return sorted(((r.doc_id, r.n_words, sum(b - a for a, b in r.spans), ",".join(r["items"])) for r in found.collect()), key=repr)


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_matches_equal_the_rule(spark, monkeypatch):
    rng = random.Random(6)
    items = [(i, prose(rng, rng.randint(11, 30))) for i in range(12)] + [(100, "Only, three WORDS"), (101, "the"), (102, None), (103, "?!"), (2, "second text of an id")]
    docs = [(i, prose(rng, 60)) for i in range(20)]
    for i in range(30, 45):
        own = rng.choice(items[:12])[1].split()
        cut = own[rng.randint(0, 3):][:rng.randint(8, 20)]
        docs.append((i, prose(rng, 5) + " -- " + "-".join(cut).upper() + ". " + prose(rng, 3)))
    docs += [(50, "x only three\nwords the"), (51, None), (52, ""), (53, " ".join(t for _, t in items[:5])), (53, "the")]
    frame, table = documents(spark, docs).repartition(4), bench(spark, items)
    assert result(decontamination.matches(frame, table)) == by_rule(docs, items)
    # a benchmark that takes several searches, and blocks of few words
    monkeypatch.setattr(decontamination, "CHUNK_BYTES", 300)
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", 100)
    merged = decontamination.contamination(frame, table)
    want = by_rule(docs, items)
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items) for r in merged.collect()), key=repr) == sorted(
        ((d, n, h, len(t.split(",")) if t else 0) for d, n, h, t in want), key=repr)


def test_several_searches_keep_every_row(spark, monkeypatch):
    rng = random.Random(8)
    items = [(i, prose(rng, 20)) for i in range(12)]
    texts = ["a b " + items[0][1], "c d " + items[7][1], prose(rng, 22), items[3][1] + " x y"]
    docs = [(i, t) for i in (1, None) for t in texts] + [(1, texts[0]), (None, texts[1]), (None, None), (None, ""), (None, "")]
    frame, table = documents(spark, docs).repartition(3), bench(spark, items)
    monkeypatch.setattr(decontamination, "CHUNK_BYTES", 300)
    assert result(decontamination.matches(frame, table)) == by_rule(docs, items)
    assert decontamination.contamination(frame, table).count() == len(docs)


def test_proximity_allows_words_off_their_place(spark):
    docs = documents(spark, [(1, "alpha beta x gamma"), (2, "alpha beta gamma"), (3, "alpha far far far beta gamma")])
    table = bench(spark, [(7, "alpha beta gamma")])
    near = {r.doc_id: len(r["items"]) for r in decontamination.matches(docs, table, slop=1).collect()}
    exact = {r.doc_id: len(r["items"]) for r in decontamination.matches(docs, table).collect()}
    assert near == {1: 1, 2: 1, 3: 0} and exact == {1: 0, 2: 1, 3: 0}


def test_awkward_documents(spark):
    rng = random.Random(7)
    passage = prose(rng, 25)
    docs = awkward(spark, rng, [(20, "before " + passage), (21, passage[:40])])
    table = bench(spark, [(1, passage), (None, "one"), (3, None)])
    assert result(decontamination.matches(docs, table)) == by_rule([(r.doc_id, r.text) for r in docs.collect()], [(1, passage)])
    clean = decontamination.without_contaminated(docs, table)
    assert clean.columns == docs.columns and clean.count() == docs.count() - 1 and clean.filter("doc_id = 20").count() == 0
    for d, b in ((docs, table.limit(0)), (docs.limit(0), table)):
        assert decontamination.contamination(d, b).filter("contaminated").count() == 0
        assert decontamination.without_contaminated(d, b).count() == d.count()
