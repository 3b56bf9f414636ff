import random
import re

import pytest

from placetally.llm import licenses
from placetally.llm.licenses import GAP, RULES, SENTENCES, SLOT_WORDS, Recogniser, normalised
from tests.llm.tables import documents

RECOGNISER = Recogniser(SENTENCES, RULES, GAP)
BSD = [SENTENCES[s][0] for s in ("bsd-permit", "bsd-source", "bsd-binary")]


def found(text):
    return RECOGNISER.licences(RECOGNISER.sentences(text))


@pytest.mark.parametrize("holder", [
    "of the copyright holder nor the names of its contributors", "of Acme, Inc. nor the names of its contributors",
    "of the University of Northern\n * Somewhere nor the\n * names of its contributors", "of Jane Doe",
])
def test_any_holder_is_bsd_3(holder):
    third = f"Neither the name {holder} may be used to endorse or promote products derived from this software without specific prior written permission."
    assert found("\n".join([*BSD, third])) == ["BSD-3-Clause"]
    assert found("BSD 3-Clause License\n\n" + "\n".join(f"{i}. {x}" for i, x in enumerate([*BSD, third]))) == ["BSD-3-Clause"]
    assert found("\n".join(BSD)) == ["BSD-2-Clause"]


def test_too_long_a_name_is_none():
    third = "Neither the name {} may be used to endorse or promote products derived from this software without specific prior written permission."
    assert found("\n".join([*BSD, third.format("x " * SLOT_WORDS)])) == ["BSD-3-Clause"]
    assert found("\n".join([*BSD, third.format("x " * (SLOT_WORDS + 1))])) == ["BSD-2-Clause"]


@pytest.mark.parametrize("text, licence", [
    ("// SPDX-License-Identifier: MIT\nint x;", "MIT"),
    ("/* SPDX-License-Identifier: GPL-2.0-or-later */", "GPL-2.0-or-later"),
    ("# SPDX-License-Identifier: (MIT OR Apache-2.0)", "MIT OR Apache-2.0"),
    ("SPDX-License-Identifier: BSD-3-Clause AND CC-BY-SA-3.0", "BSD-3-Clause AND CC-BY-SA-3.0"),
    ("                 Apache License\n           Version 2.0, January 2004\n        http://www.apache.org/licenses/", "Apache-2.0"),
    ("GNU GENERAL PUBLIC LICENSE\n Version 3, 29 June 2007\n", "GPL-3.0-only"),
    ("This file is distributed under the MIT License.", "MIT"),
    ("Licensed under the MIT license (see LICENSE)", "MIT"),
    ("This little\nprogram is released under the terms of the GNU General Public License, version 2.", "GPL-2.0-only"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License.", "CC-BY-SA-3.0"),
    ("Published under CC BY-NC-ND 4.0", "CC-BY-NC-ND-4.0"),
    ("To the extent possible under law, Jo Doe\nhas waived all copyright and related or neighboring rights to This Work.", "CC0-1.0"),
])
def test_common_forms(text, licence):
    assert found(text) == [licence] and found(f"Some words.\n{text}\nMore words.") == [licence]


@pytest.mark.parametrize("text", [
    "SPDX-License-Identifier: MITX", "The MIT people said so.", "This is licensed.", "Licensed under the sun", "", " . ", "This " * 5_000,
])
def test_others_give_nothing(text):
    assert found(text) == []


def by_rule(text):
    """Every run of fragments against every known sentence as a pattern."""
    parts = [normalised(x) for x in re.split(r"[\n.!?;:]+(?=\s|$)|\n", text.lower())]
    parts = [p for p in parts if p]
    forms = {}
    for name, some in SENTENCES.items():
        for form in some:
            slot = rf"\S+(?: \S+){{0,{SLOT_WORDS - 1}}}"
            words = [re.escape(" ".join(normalised(p))) for p in form.split("<name>")]
            pattern = re.sub(r"^ | $", "", f" {slot} ".join(words))
            forms.setdefault(normalised(form)[0], []).append((re.compile(pattern), name))
    out, k = [], 0
    while k < len(parts):
        for end in range(len(parts), k, -1):
            run = " ".join(w for p in parts[k:end] for w in p)
            names = {name for pattern, name in forms.get(parts[k][0], ()) if pattern.fullmatch(run)}
            if names:
                out.append((names, k, end))
                k = end
                break
        else:
            k += 1
    return out


def test_sentences_equal_those_of_a_plain_search():
    rng = random.Random(8)
    plain = [form for some in SENTENCES.values() for form in some[:3]]
    for _ in range(40):
        pieces = []
        for _ in range(rng.randint(1, 8)):
            form = rng.choice(plain).replace("<name>", " ".join(rng.choices(["Acme", "Inc.", "of", "a\n", "the", "under"], k=rng.randint(1, 26))))
            if rng.random() < 0.3:
                words = form.split(" ")
                words.insert(rng.randrange(len(words) + 1), rng.choice(["\n", "x", "nor.", ""]))
                form = " ".join(words)
            pieces.append(form)
        text = rng.choice(["\n", " ", "\n\n"]).join(pieces)
        got, expected = RECOGNISER.sentences(text), by_rule(text)
        assert [x[1:] for x in got] == [x[1:] for x in expected], text
        assert all(g[0] in e[0] for g, e in zip(got, expected))


def test_awkward_rows(spark):
    rows = [(1, None), (2, ""), (3, "SPDX-License-Identifier: MIT"), (3, "SPDX-License-Identifier: MIT"), (None, "Released under the MIT License.")]
    docs = documents(spark, rows)
    got = sorted(((r.doc_id, tuple(r.licences)) for r in licenses.scan_licences(docs).collect()), key=repr)
    assert got == sorted([(1, ()), (2, ()), (3, ("MIT",)), (3, ("MIT",)), (None, ("MIT",))], key=repr)
