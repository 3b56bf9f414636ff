import random

import numpy as np

from placetally.llm import language_id, licenses, token_counts, toxicity
from tests.llm.tables import awkward, documents, prose

VOWELS = {"aa": "aeo", "bb": "iuy", "cc": "äöü", "dd": "áéí"}


def spoken(rng, lang, n):
    return " ".join("".join(rng.choice("bdfgklmnprst") + rng.choice(VOWELS[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def test_languages_are_told_apart(spark):
    rng = random.Random(10)
    rows = [(i, spoken(rng, lang := rng.choice(list(VOWELS)), rng.randint(3, 60)), lang, "s") for i in range(800)]
    rows += [(900, None, "aa", "s"), (901, "", "aa", "s"), (902, "12 34 !?", "aa", "s"), (903, spoken(rng, "cc", 50_000), None, "s")]
    docs = documents(spark, rows).repartition(3)
    got = {r.doc_id: r for r in language_id.identify(docs, language_id.fit_on(docs)).collect()}
    assert [got[i].lang_pred for i in (900, 901, 902, 903)] == ["und", "und", "und", "cc"]
    tested = [r for r in rows[:800] if got[r[0]].held_out]
    assert len(tested) > 100 and np.mean([got[r[0]].lang_pred == r[2] for r in tested]) > 0.98
    assert all(0 <= r.score <= 1 for r in got.values()) and any(not r.held_out for r in got.values())


def test_codewords_correct_errors():
    code = language_id.codewords(6)
    apart = (language_id.BITS - code @ code.T) / 2 + np.eye(6) * 99
    assert apart.min() >= 8 and not (np.abs(code.sum(axis=0)) == 6).any()


def test_languages_of_awkward_documents(spark):
    docs = awkward(spark, random.Random(11))
    model = language_id.fit_on(docs)
    assert model.languages == ["en"]
    got = [(r.doc_id, r.lang_pred) for r in language_id.identify(docs, model).collect()]
    assert len(got) == docs.count() and dict(got)[2] == "und" and dict(got)[8] == "en"
    empty = docs.limit(0)
    assert {r.lang_pred for r in language_id.identify(docs, language_id.fit_on(empty)).collect()} == {"und"}
    assert language_id.identify(empty, model).count() == 0


def labelled(spark, rng, n):
    bad = ["grubbel", "snorkwit", "blathead", "wurzel"]
    rows, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        words = prose(rng, rng.randint(5, 300)).split()
        for _ in range(rng.randint(1, 6) * toxic):
            words.insert(rng.randint(0, len(words)), rng.choice(bad) + rng.choice(["", "s", ","]))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_toxic_documents_are_found(spark):
    rows, labels = labelled(spark, random.Random(12), 1_200)
    docs = documents(spark, rows).repartition(3)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = toxicity.score(docs, toxicity.fit_on(docs, table)).collect()
    truth = {i: t for i, _, t in labels}
    tested = [r for r in got if r.held_out]
    assert len(tested) > 150 and np.mean([r.predicted == truth[r.doc_id] for r in tested]) > 0.97
    assert all(r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in got)


def test_toxicity_of_awkward_documents(spark):
    docs = awkward(spark, random.Random(13))
    none = spark.createDataFrame([(1, 1, None), (None, 0, 1), (99, 0, 1)], "doc_id long, quality int, toxic int")
    for labels in (none, none.limit(0), spark.createDataFrame([(1, 0, 0), (5, 0, 1), (5, 0, 0), (8, 0, 1)], none.schema)):
        model = toxicity.fit_on(docs, labels)
        assert toxicity.score(docs, model).count() == docs.count()
        kept = toxicity.without_toxic(docs, model)
        assert kept.columns == docs.columns and kept.filter("score <> 'mine'").count() == 0
        assert toxicity.without_toxic(docs.limit(0), model).count() == 0


def test_windows_hold_the_whole_text():
    text = prose(random.Random(14), 500) + "\n x" + "y" * 999
    assert b"".join(toxicity.windows(text.encode())).split() == text.lower().encode().split()
    assert toxicity.windows(b" \n") == []


def greedy(word, vocabulary):
    at = n = 0
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in vocabulary), None)
        if end is None:
            return 1
        at, n = end, n + 1
    return n


def test_token_counts_equal_greedy_matching(spark):
    rng = random.Random(15)
    for _ in range(200):
        vocabulary = [bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(0, 12))]
        words = [bytes(rng.choice(b"abcd") for _ in range(rng.randint(0, 12))) for _ in range(30)]
        assert token_counts.Automaton(vocabulary).count(words).tolist() == [greedy(w, set(vocabulary)) for w in words]
    pieces = token_counts.read_vocabulary(token_counts.VOCABULARY)
    docs = awkward(spark, rng, [(30, "word" * 300 + " Häuser 12.5")])
    known = set(pieces)
    for r in token_counts.count_tokens(docs, pieces).join(docs.filter("doc_id not in (5, 1)").select("doc_id", "text"), "doc_id").collect():
        words = (r.text or "").encode().split()
        assert (r.n_words, r.n_tokens) == (len(words), sum(greedy(b" " + w, known) for w in words))
    assert token_counts.count_tokens(docs, pieces).count() == docs.count()
    assert token_counts.count_tokens(docs.limit(0), pieces).count() == 0


def test_rare_languages_are_sampled_beside_large_ones(spark):
    rng = random.Random(18)
    rows = [(i, spoken(rng, lang, 8), lang, "s") for i, lang in enumerate(["aa", "bb"] * 1_500 + ["cc"] * 40)]
    rows += [(10_000 + i, spoken(rng, "dd", 8), f"x{i:03}", "s") for i in range(230)]
    sampled = language_id.sample_of(documents(spark, rows).repartition(3), sample=5).collect()
    n = {lang: sum(r.lang == lang for r in sampled) for lang in ("aa", "bb", "cc")}
    assert n == {"aa": 5, "bb": 5, "cc": 5}
    known = {r[2] for r in documents(spark, rows).filter(~language_id.held_out("doc_id")).select("doc_id", "text", "lang").collect()}
    assert {r.lang for r in sampled} == known and len(known) > 150


def test_licences_of_wrapped_texts(spark):
    import textwrap

    names = ("mit-grant", "mit-notice", "no-warranty")
    texts = [(w, "\n\n".join(textwrap.fill(licenses.SENTENCES[s][0], w) for s in names)) for w in (30, 40, 60, 66, 72, 80, 200)]
    texts += [(1_000 + w, "\n".join("# " + line for line in t.split("\n"))) for w, t in texts]
    far = licenses.SENTENCES["mit-grant"][0] + " x." * (licenses.GAP + 1) + " " + licenses.SENTENCES["mit-notice"][0]
    got = {r.doc_id: r.licences for r in licenses.scan_licences(documents(spark, [*texts, (1, far), (2, far.replace(" x.", "", 1))])).collect()}
    assert got == {i: ["MIT"] for i, _ in texts} | {1: [], 2: ["MIT"]}


def test_licences(spark):
    texts = {
        1: "Words.\nLicensed under the Apache License, Version 2.0.\nMore words. All rights reserved.",
        2: "released under\nthe mit LICENSE! and so on",
        3: "They say it is released under the MIT License.",
        4: "\n".join(licenses.SENTENCES[s][0] for s in ("bsd-permit", "bsd-source", "bsd-binary", "bsd-name")),
        5: "\n\n".join(licenses.SENTENCES[s][0] for s in ("bsd-permit", "bsd-source", "bsd-binary")),
        6: "\n".join(licenses.SENTENCES[s][0] for s in ("mit-name", "mit-grant", "mit-notice", "no-warranty")),
        7: licenses.SENTENCES["bsd-permit"][0],
        8: "All rights reserved. All rights reserved.",
        9: None, 10: "", 11: licenses.SENTENCES["mit-grant"][0] + " x. " * 50 + licenses.SENTENCES["mit-notice"][0],
        12: "This work is licensed under the GNU General Public License, version 3. " + prose(random.Random(1), 20_000),
    }
    got = {r.doc_id: (r.licences, len(r.sentences)) for r in licenses.scan_licences(documents(spark, list(texts.items()))).collect()}
    assert got == {
        1: (["Apache-2.0", "all-rights-reserved"], 2), 2: (["MIT"], 1), 3: ([], 0), 4: (["BSD-3-Clause"], 4), 5: (["BSD-2-Clause"], 3),
        6: (["MIT"], 4), 7: ([], 1), 8: (["all-rights-reserved"] * 2, 2), 9: ([], 0), 10: ([], 0), 11: ([], 2), 12: (["GPL-3.0-only"], 1),
    }
    docs = awkward(spark, random.Random(16))
    assert licenses.scan_licences(docs).count() == docs.count() and licenses.scan_licences(docs.limit(0)).count() == 0


def test_toxic_words_of_ordinary_syllables_are_found():
    rng = random.Random(17)
    syllables = ["ba", "do", "fi", "gu", "ke", "lo", "mi", "nu", "pe", "ra", "so", "ti"]
    bad = ["badofigukelo", "kelomitirafi", "nuperasogudo"]

    def text(toxic):
        words = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(20, 80))]
        words = [w for w in words if w not in bad]
        return " ".join([*words, rng.choice(bad)] if toxic else words).encode()

    labels = [int(i % 4 == 0) for i in range(1_600)]
    texts = [text(label) for label in labels]
    model = toxicity.fit(texts[:1_200], labels[:1_200])
    found = model.scores(texts[1_200:]) >= 0.5
    truth = np.array(labels[1_200:]) == 1
    assert found[truth].mean() > 0.6 and truth[found].mean() > 0.85


def test_standard_notices():
    recogniser = licenses.Recogniser(licenses.SENTENCES, licenses.RULES, licenses.GAP)
    texts = {
        "This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\n"
        "the Free Software Foundation; either version 2 of the License, or\n(at your option) any later version.": "GPL-2.0-or-later",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.": "CC-BY-4.0",
        "This project is licensed under the MIT License": "MIT",
        licenses.NOTICES["ISC"][0]: "ISC", licenses.NOTICES["AGPL-3.0-or-later"][0]: "AGPL-3.0-or-later",
        licenses.NOTICES["EPL-2.0"][0]: "EPL-2.0", licenses.SENTENCES["gpl-free"][0]: "GPL-3.0-or-later",
    }
    assert {t: recogniser.licences(recogniser.sentences(t)) for t in texts} == {t: [name] for t, name in texts.items()}


def test_codewords_of_many_languages_stay_apart():
    for n in (5, 16, 60, 300):
        bits = language_id.bits_for(n)
        code = language_id.codewords(n, bits)
        apart = (bits - code @ code.T) / 2 + np.eye(n) * 99
        assert apart.min() >= 8, n
    assert language_id.bits_for(0) == language_id.bits_for(16) == language_id.BITS


def test_sample_of_repeated_ids_is_the_same_in_any_order(spark):
    rows = [(i % 7, f"text {i} " * 900, "en" if i % 2 else "de", "src0") for i in range(60)]
    rows += [(1, None, "en", "src0"), (None, "x", "en", "src0"), (2, "y", None, "src0")]
    docs = documents(spark, rows)
    some = [
        sorted(tuple(r) for r in language_id.sample_of(d, sample=4, chars=50).collect())
        for d in (docs.repartition(5), docs.orderBy("text", ascending=False).coalesce(1))
    ]
    assert some[0] == some[1] and len({(r[0], r[2]) for r in some[0]}) == len(some[0]) <= 8
    before = language_id.BROADCAST_BYTES
    try:
        language_id.BROADCAST_BYTES = -1
        assert sorted(tuple(r) for r in language_id.sample_of(docs, sample=4, chars=50).collect()) == some[0]
    finally:
        language_id.BROADCAST_BYTES = before
