"""Licence scans: known sentences become identifiers, and ordered rules match sequences of identifiers.

A text is cut into sentences twice, once across line breaks within a paragraph and once line by line, because a
notice may be wrapped or stand on a line of its own. A sentence is normalised (lower case, words only, "licence"
spelt "license", holder and year of a copyright line dropped) and looked up. Rules are tried in their order at each
identifier; a rule matches a run of identifiers with at most ``MAX_GAP`` unknown sentences between two of them, and
the identifiers that it uses are not used again.

Defined cases: null and empty texts match nothing and still give a row; repeated rows give repeated results; of
rules that match at one place the first listed wins; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import DataFrame

from strataline.llm import license_names
from strataline.llm.common import map_rows

MAX_GAP = 1
# Identifiers of sentences that name a licence begin so; they are rules by themselves.
NAME = "name:"

# Sentences of public licences and of the notices that name them.
SENTENCES = {
    "mit-name": "Released under the MIT License.",
    "mit-notice": "This software is released under the MIT License.",
    "mit-title": "The MIT License (MIT)",
    "mit-title-short": "MIT License",
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions"
    ),
    "mit-keep": (
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the Software"
    ),
    "apache2-name": "Licensed under the Apache License, Version 2.0.",
    "apache2-notice": 'Licensed under the Apache License, Version 2.0 (the "License")',
    "apache2-comply": "you may not use this file except in compliance with the License",
    "apache2-copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "gpl3-name": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-free": "This program is free software",
    "gpl3-terms": (
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
        "Free Software Foundation, either version 3 of the License, or (at your option) any later version"
    ),
    "cc-by-nc-4-name": "Licensed under CC BY-NC 4.0.",
    "cc-by-4-name": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc0-name": "This work is dedicated to the public domain under CC0 1.0 license.",
    "bsd-grant": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met"
    ),
    "bsd-source": (
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer"
    ),
    "bsd-binary": (
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution"
    ),
    "bsd-endorse": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission"
    ),
    "isc-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies"
    ),
    "isc-grant-and": (
        "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies"
    ),
    "0bsd-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted"
    ),
    "bsl-grant": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software "
        "and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, "
        "distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit "
        "third-parties to whom the Software is furnished to do so, all subject to the following"
    ),
    "zlib-grant": (
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and "
        "to alter it and redistribute it freely, subject to the following restrictions"
    ),
    "unlicense-text": "This is free and unencumbered software released into the public domain",
    "cc0-text": (
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring "
        "rights to this software to the public domain worldwide"
    ),
    "gpl-title": "GNU GENERAL PUBLIC LICENSE",
    "lgpl-title": "GNU LESSER GENERAL PUBLIC LICENSE",
    "agpl-title": "GNU AFFERO GENERAL PUBLIC LICENSE",
    "gnu-2-date": "Version 2, June 1991",
    "gnu-2.1-date": "Version 2.1, February 1999",
    "gnu-3-date": "Version 3, 29 June 2007",
    "agpl-3-date": "Version 3, 19 November 2007",
    "apache-title": "Apache License",
    "apache2-date": "Version 2.0, January 2004",
    "mpl2-title": "Mozilla Public License Version 2.0",
    "mpl2-copy": (
        "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/"
    ),
    "epl1-title": "Eclipse Public License - v 1.0",
    "epl2-title": "Eclipse Public License - v 2.0",
    "gnu-later-2": "either version 2 of the License, or (at your option) any later version",
    "gnu-later-2.1": "either version 2.1 of the License, or (at your option) any later version",
    "gnu-later-3": "either version 3 of the License, or (at your option) any later version",
    "gnu-only-2": "version 2 of the License",
    "gnu-only-2.1": "version 2.1 of the License",
    "gnu-only-3": "version 3 of the License",
}


class Rule(NamedTuple):
    license: str
    sequence: tuple[str, ...]


# Longer and more specific rules come first.
RULES = (
    Rule("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    Rule("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    Rule("MIT", ("mit-title", "copyright", "mit-grant", "mit-keep")),
    Rule("MIT", ("mit-title-short", "copyright", "mit-grant", "mit-keep")),
    Rule("MIT", ("mit-grant", "mit-keep")),
    Rule("MIT", ("mit-notice",)),
    Rule("MIT", ("mit-name",)),
    Rule("Apache-2.0", ("apache2-notice", "apache2-comply", "apache2-copy")),
    Rule("Apache-2.0", ("apache2-notice", "apache2-comply")),
    Rule("Apache-2.0", ("apache2-name",)),
    Rule("GPL-3.0-or-later", ("gpl-free", "gpl3-terms")),
    Rule("GPL-3.0-only", ("gpl3-name",)),
    Rule("CC-BY-NC-4.0", ("cc-by-nc-4-name",)),
    Rule("CC-BY-4.0", ("cc-by-4-name",)),
    Rule("CC0-1.0", ("cc0-name",)),
    Rule("ISC", ("isc-grant",)),
    Rule("ISC", ("isc-grant-and",)),
    Rule("0BSD", ("0bsd-grant",)),
    Rule("BSL-1.0", ("bsl-grant",)),
    Rule("Zlib", ("zlib-grant",)),
    Rule("Unlicense", ("unlicense-text",)),
    Rule("CC0-1.0", ("cc0-text",)),
    Rule("GPL-2.0-only", ("gpl-title", "gnu-2-date")),
    Rule("GPL-3.0-only", ("gpl-title", "gnu-3-date")),
    Rule("LGPL-2.1-only", ("lgpl-title", "gnu-2.1-date")),
    Rule("LGPL-3.0-only", ("lgpl-title", "gnu-3-date")),
    Rule("AGPL-3.0-only", ("agpl-title", "agpl-3-date")),
    Rule("Apache-2.0", ("apache-title", "apache2-date")),
    Rule("MPL-2.0", (f"{NAME}MPL-2.0", "mpl2-copy")),
    Rule("MPL-2.0", ("mpl2-title",)),
    Rule("EPL-1.0", ("epl1-title",)),
    Rule("EPL-2.0", ("epl2-title",)),
    Rule("GPL-3.0-or-later", ("gpl3-terms",)),
    Rule("MIT", ("mit-grant",)),
    Rule("Apache-2.0", ("apache2-notice",)),
    # Notices of the Free Software Foundation that a semicolon divides before the version.
    *(
        Rule(f"{family}-{version if '.' in version else version + '.0'}-{end}", (f"{NAME}{family}-unspecified", f"gnu-{word}-{version}"))
        for family, versions in (("GPL", ("2", "3")), ("LGPL", ("2", "2.1", "3")), ("AGPL", ("3",)))
        for version in versions
        for word, end in (("later", "or-later"), ("only", "only"))
    ),
)

# The point of "v. 2.0" ends no sentence.
_END = r"(?<!\b[vV])[.;:!?]+(?=\s|$)"
_IN_PARAGRAPH = re.compile(rf"{_END}|\n[^\S\n]*\n")
_IN_LINE = re.compile(rf"{_END}|\n")
_WORDS = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")
_COPYRIGHT = re.compile(r"\s*(?:copyright\b|\(c\)\s*[0-9]{4}|©)", re.IGNORECASE)
_MENTIONS = re.compile(
    r"licen[sc]|copyright|redistribut|permission|free software|©|public domain|"
    r"(?:released|distributed|published|provided|available|offered|issued|shared|covered|governed|subject)\s+(?:under|by|to)\s",
    re.IGNORECASE,
)
_TAG = re.compile(r"(?:SPDX-License-Identifier|^\W{0,8}Licen[sc]e)[^\S\n]*:[^\S\n]*([^\n]+)", re.IGNORECASE | re.MULTILINE)
_LATER = re.compile(r"(?<=[0-9])\+")
_ENDORSE = re.compile(r"(neither the name of) .* (nor the names of)(?: its| their)? (contributors may be used to endorse)")


def normalised(sentence: str) -> str:
    # A line of any length; over lines, what follows the holder may be more than their names.
    if _COPYRIGHT.match(sentence) and (len(sentence) < 200 or "\n" not in sentence.strip()):
        return "copyright"
    words = " ".join(_WORDS.findall(sentence.lower().replace("licence", "license")))
    # The holder is named in the last condition of BSD licences.
    return _ENDORSE.sub(r"\1 the copyright holder \2 its \3", words)


def name_in(sentence: str) -> str | None:
    """Identifier of a sentence that puts something under a licence."""
    name = license_names.noticed(normalised(_LATER.sub(" or later", sentence)))
    return name and NAME + name


def tags(text: str) -> Iterator[tuple[int, int, str]]:
    """Start, end and identifier of the tags and headings that give a licence."""
    for m in _TAG.finditer(text):
        if name := license_names.tagged(normalised(_LATER.sub(" or later", m[1]))):
            yield m.start(), m.start(1) + len(m[1].rstrip()), NAME + name


def known_sentences(sentences: dict[str, str]) -> dict[str, str]:
    """Identifier by normalised sentence."""
    return {normalised(text.rstrip(".")): name for name, text in sentences.items()} | {"copyright": "copyright"}


def _cut(text: str, ends: re.Pattern) -> Iterator[tuple[int, int]]:
    start = 0
    for m in ends.finditer(text):
        yield start, m.start()
        start = m.end()
    yield start, len(text)


def identified(text: str, known: dict[str, str], names: bool = False) -> list[tuple[int, int, int, str]]:
    """Place in the sequence of sentences, start, end and identifier of each known sentence, in text order.

    With ``names``, sentences that name a public licence are known too. Sentences have any length; a name that goes on
    in the next lines is looked for in that many characters from its beginning which four known sentences have.
    """
    lead = max(len(k) for k in known) * 4
    found: dict[int, tuple[int, int, str]] = {a: (a, b, name) for a, b, name in tags(text)} if names else {}
    starts: list[int] = []
    for ends in (_IN_LINE, _IN_PARAGRAPH):
        before = sorted(found)
        for a, b in _cut(text, ends):
            body = text[a:b]
            a += len(body) - len(body.lstrip())
            if a >= b:
                continue
            if ends is _IN_PARAGRAPH:
                starts.append(a)
            if a in found and not found[a][2].startswith(NAME):
                continue
            if ends is _IN_PARAGRAPH:
                for x in before[bisect_right(before, a) : bisect_left(before, b)]:
                    _, end, old = found[x]
                    if old.startswith(NAME) and end < b and (name := name_in(text[x : min(b, x + lead)])) not in (None, old):
                        found[x] = (x, b, name)
            name = known.get(normalised(text[a:b])) or (name_in(text[a:b]) if names else None)
            # A name that goes on in the next line is read from the paragraph, and not again where a line has it.
            if not name or a in found and found[a][1] >= b:
                continue
            if not name.startswith(NAME) or bisect_right(before, a) == bisect_left(before, b):
                found[a] = (a, b, name)
    places = {a: i for i, a in enumerate(sorted({*starts, *found}))}
    return [(places[a], a, b, name) for a, (_, b, name) in sorted(found.items())]


def matched(sequence: list[tuple[int, int, int, str]], rules: tuple[Rule, ...]) -> list[tuple[str, int, int]]:
    """Licence, start and end of each rule that matches, in text order."""
    out, at = [], 0
    while at < len(sequence):
        for rule in rules:
            part = sequence[at : at + len(rule.sequence)]
            if tuple(x[3] for x in part) == rule.sequence and all(
                b[0] - a[0] <= 1 + MAX_GAP for a, b in zip(part, part[1:], strict=False)
            ):
                out.append((rule.license, part[0][1], part[-1][2]))
                at += len(part)
                break
        else:
            _, a, b, name = sequence[at]
            if name.startswith(NAME):
                out.append((name.removeprefix(NAME), a, b))
            at += 1
    return out


def scan(
    docs: DataFrame,
    sentences: dict[str, str] | None = None,
    rules: tuple[Rule, ...] = RULES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: its id, ``sentences`` (identifiers in order) and ``matches`` (license, start, end)."""
    known = known_sentences(SENTENCES if sentences is None else sentences)
    # Built-in sentences all mention one of a few words; texts without any of them need no cutting.
    quick = sentences is None

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, text in rows:
            if not text or (quick and not _MENTIONS.search(text)):
                yield doc_id, [], []
                continue
            sequence = identified(text, known, quick)
            yield (
                doc_id,
                [name for *_, name in sequence],
                [{"license": x, "start": a, "end": b} for x, a, b in matched(sequence, rules)],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return map_rows(
        docs.select(id_col, text_col),
        run,
        f"{id_col} {kind}, sentences array<string>, matches array<struct<license:string,start:int,end:int>>",
    )
