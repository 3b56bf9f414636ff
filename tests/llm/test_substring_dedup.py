import hashlib
import random

from placetally.llm import substring_dedup
from tests.llm.tables import awkward, documents, prose


def by_rule(docs, n=13):
    """docs: (doc_id, text); windows are compared with those of smaller ids."""
    first = {}
    words = [(i, (t or "").encode().split()) for i, t in docs]
    for i, w in words:
        for k in range(len(w) - n + 1):
            key = tuple(w[k:k + n])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for k in range(len(w) - n + 1):
            if i is not None and first[tuple(w[k:k + n])] < i:
                gone[k:k + n] = [True] * n
        rest = [x for x, g in zip(w, gone) if not g]
        out.append((i, len(w), len(w) - len(rest), hashlib.sha256(b" ".join(rest)).hexdigest()))
    return sorted(out, key=repr)


def result(spark, docs):
    got = substring_dedup.substring_digest(docs)
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got.collect()), key=repr)


def test_repeats_equal_the_rule(spark, monkeypatch):
    rng = random.Random(4)
    line, page = prose(rng, 20), prose(rng, 300)
    docs = []
    for i in range(60):
        text = prose(rng, rng.randint(1, 80))
        if i % 3 == 0:
            text += "\n" + line + "\n" + prose(rng, 15)
        if i % 7 == 0:
            words = page.split()
            words[rng.randint(0, 299)] = "other"
            text = " ".join(words) + " " + text
        docs.append((i, text))
    docs += [(70, "a " * 500), (71, "a " * 14), (72, None), (73, ""), (74, line), (75, " ".join(line.split()[:12])), (5, page)]
    docs.append(docs[6])
    frame = documents(spark, docs).repartition(5)
    want = by_rule(docs)
    assert sum(w[2] for w in want) > 1_000
    assert result(spark, frame) == want
    # groups of another size, and keys that are extended to the whole window
    monkeypatch.setattr(substring_dedup, "GROUP_BYTES", 2_000)
    monkeypatch.setattr(substring_dedup, "EXTEND_LEAST", 2)
    monkeypatch.setattr(substring_dedup, "EXTEND_EVERY", 1)
    assert len(substring_dedup.long_keys(frame.filter("text is not null"), 13)) > 3
    assert result(spark, frame) == want


def test_awkward_documents(spark):
    rng = random.Random(5)
    text = prose(rng, 100)
    docs = awkward(spark, rng, [(20, text), (21, "x y\n" + text), (22, text)])
    plain = [(r.doc_id, r.text) for r in docs.collect()]
    assert result(spark, docs) == by_rule(plain)
    kept = {(r.doc_id): r for r in substring_dedup.without_repeats(docs).collect()}
    assert kept[21].text == "x y" and kept[21].n_chars == 3 and kept[21].found == "mine" and 22 not in kept
    assert kept[2].text is None and kept[3].text == "" and kept[4].text == " \n\t" and kept[20].text == text
    none = docs.limit(0)
    assert substring_dedup.substring_digest(none).count() == substring_dedup.without_repeats(none).count() == 0


def test_maximal_repeats_are_whole_passages(spark):
    rng = random.Random(6)
    one, two = prose(rng, 40), prose(rng, 13)
    docs = documents(spark, [(1, one), (2, two), (3, f"a b {one} c {two} d"), (4, prose(rng, 50)), (5, f"{one} {two}")])
    got = {r.doc_id: r.repeats for r in substring_dedup.maximal_repeats(docs).collect()}
    assert got == {3: [[2, 42], [43, 56]], 5: [[0, 53]]}
