"""Licence notices by sentence rules: known sentences get identifiers, rules are ordered sequences of identifiers.

A known sentence may have places for names, written ``<name>``: there any 1 to ``SLOT_WORDS`` words may stand.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache, partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placetally.llm.common import slices, texts_of

TEXT_BYTES = 4 << 20
# Sentences that no rule knows may stand between those of a rule, up to so many.
GAP = 6
# Words that a place for a name takes at most.
SLOT_WORDS = 24
NAME = "<name>"
_ANY = "*"

# Fixed values from here to RULES: sentences of public licence notices, written normally.
SENTENCES = {
    "mit-name": ["Released under the MIT License.", "Licensed under the MIT License.", "The MIT License (MIT)", "MIT License"],
    "mit-grant": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
    ],
    "mit-notice": [
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software."
    ],
    "apache2-name": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\");",
        "Apache License, Version 2.0",
    ],
    "apache2-comply": ["you may not use this file except in compliance with the License."],
    "gpl3-name": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 3.",
    ],
    "gpl-free": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version."
    ],
    "lgpl3-name": ["Licensed under the GNU Lesser General Public License, version 3."],
    "mpl2-name": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ],
    "bsd-permit": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:"
    ],
    "bsd-source": [
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer."
    ],
    "bsd-binary": [
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution."
    ],
    "bsd-name": [
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.",
        "Neither the name <name> may be used to endorse or promote products derived from this software without specific prior "
        "written permission.",
        "The name <name> may not be used to endorse or promote products derived from this software without specific prior written "
        "permission.",
        "The names <name> may not be used to endorse or promote products derived from this software without specific prior written "
        "permission.",
    ],
    "ccby4-name": ["Licensed under CC BY 4.0.", "This work is licensed under CC BY 4.0."],
    "ccbysa4-name": ["Licensed under CC BY-SA 4.0.", "This work is licensed under CC BY-SA 4.0."],
    "ccbync4-name": ["Licensed under CC BY-NC 4.0.", "This work is licensed under CC BY-NC 4.0."],
    "reserved": ["All rights reserved.", "All rights reserved by the author."],
    "no-warranty": [
        "The software is provided \"as is\", without warranty of any kind, express or implied, including but not limited to "
        "the warranties of merchantability, fitness for a particular purpose and noninfringement."
    ],
    "public-domain": ["This is free and unencumbered software released into the public domain."],
}
_FREE = (
    "This {what} is free software; you can redistribute it and/or modify it under the terms of the GNU {name} as published by "
    "the Free Software Foundation; either version {version} of the License, or (at your option) any later version."
)
# Notices that are one sentence, by licence.
NOTICES = {
    "GPL-2.0-or-later": [_FREE.format(what=w, name="General Public License", version="2") for w in ("program", "file", "library")],
    "GPL-3.0-or-later": [_FREE.format(what=w, name="General Public License", version="3") for w in ("file", "library")],
    "LGPL-2.1-or-later": [_FREE.format(what=w, name="Lesser General Public License", version="2.1") for w in ("library", "program", "file")],
    "LGPL-3.0-or-later": [_FREE.format(what=w, name="Lesser General Public License", version="3") for w in ("library", "program", "file")],
    "AGPL-3.0-or-later": [_FREE.format(what=w, name="Affero General Public License", version="3") for w in ("program", "file", "library")],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
        "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "EPL-2.0": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which "
        "is available at https://www.eclipse.org/legal/epl-2.0/",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0.",
    ],
    "MIT": ["This project is licensed under the MIT License.", "This project is licensed under the MIT License - see the LICENSE file for details."],
}
for _id, _name in (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial")):
    NOTICES[f"CC-{_id}-4.0"] = [
        f"{start} licensed under a Creative Commons {_name} 4.0 International License." for start in ("This work is", "Licensed", "This article is")
    ] + [f"This work is licensed under the Creative Commons {_name} 4.0 International License."]
# Openings of full texts, and other sentences that stand alone.
for _id, _forms in {
    "Apache-2.0": ["Apache License Version 2.0, January 2004"],
    "GPL-2.0-only": ["GNU General Public License Version 2, June 1991"],
    "GPL-3.0-only": ["GNU General Public License Version 3, 29 June 2007"],
    "LGPL-2.1-only": ["GNU Lesser General Public License Version 2.1, February 1999"],
    "LGPL-3.0-only": ["GNU Lesser General Public License Version 3, 29 June 2007"],
    "AGPL-3.0-only": ["GNU Affero General Public License Version 3, 19 November 2007"],
    "MPL-2.0": ["Mozilla Public License Version 2.0"],
    "EPL-2.0": ["Eclipse Public License - v 2.0"],
    "BSD-2-Clause": ["BSD 2-Clause License"],
    "BSD-3-Clause": ["BSD 3-Clause License"],
    "ISC": ["ISC License"],
    "CC0-1.0": [
        "CC0 1.0 Universal",
        "To the extent possible under law, <name> has waived all copyright and related or neighboring rights to <name>.",
    ],
}.items():
    NOTICES.setdefault(_id, []).extend(_forms)
# Names by which licences are referred to.
NAMES = {
    "MIT": ["MIT License", "MIT licence", "MIT"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0"],
    "GPL-2.0-only": ["GNU General Public License, version 2", "GNU GPL v2", "GPLv2"],
    "GPL-3.0-only": ["GNU General Public License, version 3", "GNU GPL v3", "GPLv3"],
    "LGPL-2.1-only": ["GNU Lesser General Public License, version 2.1"],
    "LGPL-3.0-only": ["GNU Lesser General Public License, version 3"],
    "AGPL-3.0-only": ["GNU Affero General Public License, version 3"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL 2.0"],
    "EPL-2.0": ["Eclipse Public License 2.0"],
    "BSD-2-Clause": ["BSD 2-Clause License", "2-Clause BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "3-Clause BSD License"],
    "ISC": ["ISC License"],
    "Unlicense": ["Unlicense"],
    "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal", "CC0"],
}
for _id, _name in (
    ("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"), ("BY-ND", "Attribution-NoDerivatives"),
    ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
):
    for _version, _form in (("2.0", "Generic"), ("2.5", "Generic"), ("3.0", "Unported"), ("4.0", "International")):
        NAMES[f"CC-{_id}-{_version}"] = [
            f"CC {_id} {_version}", f"Creative Commons {_name} {_version} License", f"Creative Commons {_name} {_version} {_form} License"
        ]
# Sentences that refer to a licence by its name, whole or with a pointer to its text behind it.
REFERENCES = [
    f"{start}{verb} under {terms}{{name}}{end}"
    for start in ("", "This <name> is ") for verb in ("licensed", "released", "distributed", "available", "published")
    for terms in ("", "a ", "the ", "the terms of the ") for end in ("", " see <name>")
]
# Tags of source files; a tag may join two licences.
TAG = "SPDX-License-Identifier: {name}"
SENTENCES |= {f"notice-{k.lower()}": forms for k, forms in NOTICES.items()}
SENTENCES |= {f"named-{k.lower()}": [r.replace("{name}", n) for n in names for r in REFERENCES] for k, names in NAMES.items()}
_TAGS = sorted({*NAMES, *NOTICES})
_TAGGED = {k: k for k in _TAGS} | {f"{a} {op} {b}": f"{a} {op} {b}" for op in ("OR", "AND") for a in _TAGS for b in _TAGS if a != b}
SENTENCES |= {f"tag-{k.lower()}": [TAG.format(name=k), TAG.format(name=f"({k})")][: 1 + (" " in k)] for k in _TAGGED}
# Ordered rules: a longer one wins over those that it contains.
RULES = {
    ("mit-name",): "MIT",
    ("mit-grant", "mit-notice"): "MIT",
    ("mit-name", "mit-grant", "mit-notice"): "MIT",
    ("mit-grant", "mit-notice", "no-warranty"): "MIT",
    ("mit-name", "mit-grant", "mit-notice", "no-warranty"): "MIT",
    ("apache2-name",): "Apache-2.0",
    ("apache2-name", "apache2-comply"): "Apache-2.0",
    ("gpl3-name",): "GPL-3.0-only",
    ("gpl-free",): "GPL-3.0-or-later",
    ("lgpl3-name",): "LGPL-3.0-only",
    ("mpl2-name",): "MPL-2.0",
    ("bsd-permit", "bsd-source", "bsd-binary"): "BSD-2-Clause",
    ("bsd-permit", "bsd-source", "bsd-binary", "bsd-name"): "BSD-3-Clause",
    ("ccby4-name",): "CC-BY-4.0",
    ("ccbysa4-name",): "CC-BY-SA-4.0",
    ("ccbync4-name",): "CC-BY-NC-4.0",
    ("reserved",): "all-rights-reserved",
    ("public-domain",): "Unlicense",
}
# A name or heading in front of a longer notice of the same licence is part of it.
RULES |= {
    (f"{kind}-{k.lower()}", *rule): k for kind, known in (("notice", NOTICES), ("named", NAMES)) for rule, k in list(RULES.items())
    if k in known and len(rule) > 1
}
RULES |= {(f"notice-{k.lower()}",): k for k in NOTICES} | {(f"named-{k.lower()}",): k for k in NAMES}
RULES |= {(f"tag-{k.lower()}",): v for k, v in _TAGGED.items()}
_END = re.compile(r"[\n.!?;:]+(?=\s|$)|\n")
_WORD = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")


def normalised(sentence: str) -> list[str]:
    """Words of a sentence: lower case, ASCII letters and digits, points only inside numbers."""
    return _WORD.findall(sentence.lower())


def steps(form: str) -> list[str]:
    """Words of a known sentence, a place for a name being a step of its own."""
    out = []
    for k, part in enumerate(form.split(NAME)):
        out += ([_ANY] if k else []) + normalised(part)
    return out


class Recogniser:
    def __init__(self, sentences: dict[str, list[str]], rules: dict[tuple[str, ...], str], gap: int):
        """A trie of words; the first of two identifiers with the same words counts.  No sentence starts with a name."""
        self.trie: dict = {}
        for name, forms in sentences.items():
            for form in forms:
                node = self.trie
                for word in steps(form):
                    node = node.setdefault(word, {})
                node.setdefault("", name)
        self.by_first: dict[str, list[tuple[tuple[str, ...], str]]] = {}
        for rule, name in sorted(rules.items(), key=lambda r: (-len(r[0]), r[0])):
            self.by_first.setdefault(rule[0], []).append((rule, name))
        self.gap = gap

    @staticmethod
    def _step(states: list[tuple[dict, int]], word: str) -> list[tuple[dict, int]]:
        """States behind one more word: a node of the trie and the words taken by the name that ends there, or 0."""
        out, seen = [], set()
        for node, taken in states:
            after = [(node[word], 0)] if word in node else []
            if _ANY in node:
                after.append((node[_ANY], 1))
            if 0 < taken < SLOT_WORDS:
                after.append((node, taken + 1))
            for state in after:
                if (id(state[0]), state[1]) not in seen:
                    seen.add((id(state[0]), state[1]))
                    out.append(state)
        return out

    def sentences(self, text: str) -> list[tuple[str, int, int]]:
        """Known sentences, each from and to a place; places count the fragments that have words.

        Fragments end with a line or a mark.  A known sentence starts and ends
        with a fragment and may run over several, as wrapped lines do; the
        longest one counts, and of equally long ones that with fewer names.
        """
        parts = [x for x in _END.split(text.lower()) if _WORD.search(x)]
        words = [None] * len(parts)
        out, k = [], 0
        while k < len(parts):
            states, best, at = [(self.trie, 0)], None, k
            while at < len(parts):
                if words[at] is None:
                    words[at] = _WORD.findall(parts[at])
                for word in words[at]:
                    states = self._step(states, word)
                    if not states:
                        break
                if not states:
                    break
                at += 1
                ended = [node[""] for node, _ in states if "" in node]
                if ended:
                    best = (ended[0], at)
            if best:
                out.append((best[0], k, best[1]))
                k = best[1]
            else:
                k += 1
        return out

    def licences(self, found: list[tuple[str, int, int]]) -> list[str]:
        """Licences of a sequence of known sentences, in order; every sentence serves one rule at most."""
        out, k = [], 0
        while k < len(found):
            for rule, name in self.by_first.get(found[k][0], ()):
                part = found[k:k + len(rule)]
                near = all(b[1] - a[2] <= self.gap for a, b in zip(part, part[1:]))
                if near and tuple(x[0] for x in part) == rule:
                    out.append(name)
                    k += len(rule)
                    break
            else:
                k += 1
        return out


@lru_cache(4)
def _of_module(gap: int) -> Recogniser:
    """The recogniser of the sentences above, built once in a worker."""
    return Recogniser(SENTENCES, RULES, gap)


def _scanned(batches: Iterator[pa.RecordBatch], own: tuple[dict, dict] | None, gap: int) -> Iterator[pa.RecordBatch]:
    recogniser = Recogniser(*own, gap) if own else _of_module(gap)
    for batch in batches:
        for piece in slices(batch, "text", TEXT_BYTES):
            known, names = [], []
            for text in texts_of(piece.column("text")):
                found = recogniser.sentences(text.decode())
                known.append([x[0] for x in found])
                names.append(recogniser.licences(found))
            text_list = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(known, text_list), pa.array(names, text_list)],
                ["doc_id", "sentences", "licences"],
            )


def scan_licences(docs: DataFrame, sentences: dict = SENTENCES, rules: dict = RULES, gap: int = GAP) -> DataFrame:
    """(doc_id, sentences, licences) of every row of ``docs``: identifiers of known sentences and licences, in order.

    Whole texts are read.  Null and empty texts have neither; a sentence that
    occurs twice is listed twice; a document may have several licences.  A tag that
    joins two licences is one entry, such as ``MIT OR Apache-2.0``.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    own = None if sentences is SENTENCES and rules is RULES else (sentences, rules)
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        partial(_scanned, own=own, gap=gap),
        f"doc_id {kind}, sentences array<string>, licences array<string>",
    )
