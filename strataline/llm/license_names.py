"""Names of public licences in notices: "licensed under the X", "SPDX-License-Identifier: X".

``LICENSES`` lists what is recognised. A licence of a family named without its version is ``<family>-unspecified``.
"""

from __future__ import annotations

import re

# Names as normalised words, without and with "license" at the end, of licences that have one version.
SINGLE = {
    "MIT": "mit|expat|mit expat|mit x11|x11 mit",
    "MIT-0": "mit 0|mit no attribution",
    "ISC": "isc",
    "0BSD": "0bsd|zero clause bsd|bsd zero clause|bsd 0 clause",
    "BSD-2-Clause": "bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd|bsd 2 clause simplified|bsd two clause",
    "BSD-3-Clause": (
        "bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd|revised bsd|bsd three clause|"
        "bsd 3 clause new or revised|new or revised bsd"
    ),
    "BSD-4-Clause": "bsd 4 clause|4 clause bsd|four clause bsd|original bsd|bsd four clause",
    "BSD-unspecified": "bsd|berkeley software distribution",
    "Unlicense": "unlicense",
    "WTFPL": "wtfpl|do what the fuck you want to public",
    "Zlib": "zlib|zlib libpng",
    "PostgreSQL": "postgresql",
    "NCSA": "university of illinois ncsa open source|ncsa open source|ncsa",
}
# Name, short name and versions of licences that have several; the first form of a version is that of the identifier.
FAMILIES = {
    "GPL": ("(?:gnu )?general public license|(?:gnu )?gpl", ("1.0", "2.0", "3.0")),
    "LGPL": ("(?:gnu )?(?:lesser|library) (?:general )?public license|(?:gnu )?lgpl", ("2.0", "2.1", "3.0")),
    "AGPL": ("(?:gnu )?affero (?:general )?public license|(?:gnu )?agpl", ("1.0", "3.0")),
    "Apache": ("apache(?: software)?(?: license)?|asl", ("1.0", "1.1", "2.0")),
    "MPL": ("mozilla public license|mpl", ("1.0", "1.1", "2.0")),
    "EPL": ("eclipse public license|epl", ("1.0", "2.0")),
    "CDDL": ("common development and distribution license|cddl", ("1.0", "1.1")),
    "EUPL": ("european union public license|eupl", ("1.0", "1.1", "1.2")),
    "OFL": ("(?:sil )?open font license|(?:sil )?ofl", ("1.0", "1.1")),
    "Artistic": ("artistic(?: license)?", ("1.0", "2.0")),
    "BSL": ("boost(?: software)?(?: license)?|bsl", ("1.0",)),
    "AFL": ("academic free license|afl", ("1.1", "1.2", "2.0", "2.1", "3.0")),
    "OSL": ("open software license|osl", ("1.0", "1.1", "2.0", "2.1", "3.0")),
}
GNU = ("GPL", "LGPL", "AGPL")
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")
CC_KINDS = ("BY", "BY-SA", "BY-ND", "BY-NC", "BY-NC-SA", "BY-NC-ND")
LICENSES = (
    *SINGLE,
    *(f"{f}-{v}{end}" for f, (_, vs) in FAMILIES.items() for v in vs for end in (("-only", "-or-later") if f in GNU else ("",))),
    *(f"{f}-unspecified" for f in FAMILIES),
    *(f"CC-{k}-{v}" for k in CC_KINDS for v in CC_VERSIONS),
    *(f"CC-{k}-unspecified" for k in CC_KINDS),
    "CC0-1.0",
)

_VERSION = r"(?: ?(?:version|ver|v)?(?<!\d) ?([0-9]+(?:\.[0-9]+)*))"
_FSF = r"(?: as published by the free software foundation(?: inc)?)?"
_LATER = r"(?: (?:license )?(?:and|or)(?: at your option)?(?: any)? (?:later|newer|above|higher)(?: versions?)?)"
_SINGLE = [
    (name, re.compile(rf"(?:{'|'.join(sorted(forms.split('|'), key=len, reverse=True))})(?: public)?(?: license)?(?![\w.])"))
    for name, forms in SINGLE.items()
]
# The longest forms first, so that "bsd" does not hide "bsd 3 clause".
_FAMILIES = [
    (
        name,
        versions,
        re.compile(
            rf"(?:{forms})(?:{_FSF}(?: either| under)?{_VERSION}(?: of the license)?{_FSF}(?P<later>{_LATER})?(?P<only> only)?)?"
            r"(?: license)?(?![\w.])"
        ),
    )
    for name, (forms, versions) in FAMILIES.items()
]
_CC = re.compile(
    r"(?:creative commons|cc)(?: license)?(?P<by> (?:by|attribution))(?P<nc> nc| non ?commercial)?"
    r"(?P<end> sa| share ?alike| nd| no ?deriv(?:ative)?s?(?: works)?)?"
    rf"(?: (?:international|unported|generic))?{_VERSION}?(?: (?:international|unported|generic))?(?: public)?(?: license)?(?![\w.])"
)
_CC0 = re.compile(r"(?:creative commons )?(?:cc0|cc zero|zero)(?: v?1(?:\.0)?)?(?: universal)?(?: public domain dedication)?(?: license)?(?![\w.])")
# What may not follow a name, as it makes another one of it.
_OTHER = re.compile(r" (?:v?[0-9]|version|style|like|type|compatible|derived|based|incompatible|clause|variant)")
_AND = re.compile(r" (?:or|and)(?: the)? ")
_FORM = re.compile(
    r"(?:(?:[\w.]+ ){0,12}?(?:is|are|be) )?(?:(?:dual|also|hereby|made|free software|open source|jointly) )*"
    r"(?:licensed|released|distributed|redistributed|published|provided|available|offered|issued|shared|covered|governed|subject|"
    r"(?:(?:you can|you may) )?redistribute it and or modify it)"
    r"(?: to you)? (?:under|by|to|in accordance with) (?:either )?(?:the )?(?:terms (?:and conditions )?of )?(?:either )?(?:the |a |an )?"
)


def name_at(words: str, at: int = 0) -> tuple[str, int] | None:
    """The licence that is named at a place of normalised words, and where its name ends."""
    found = []
    if m := _CC0.match(words, at):
        found.append(("CC0-1.0", m.end()))
    if m := _CC.match(words, at):
        kind = "BY" + "-NC" * bool(m["nc"]) + ("" if not m["end"] else "-SA" if m["end"].startswith(" s") else "-ND")
        version = _full(m[m.lastindex], CC_VERSIONS) if (m.lastindex and m.group(4)) else "unspecified"
        found += [(f"CC-{kind}-{version}", m.end())] * bool(version)
    for name, versions, pattern in _FAMILIES:
        if m := pattern.match(words, at):
            if not m[1]:
                found.append((f"{name}-unspecified", m.end()))
            elif version := _full(m[1], versions):
                end = ("-or-later" if m["later"] else "-only") if name in GNU else ""
                found.append((f"{name}-{version}{end}", m.end()))
    found += [(name, m.end()) for name, pattern in _SINGLE if (m := pattern.match(words, at))]
    best = max(found, key=lambda f: f[1], default=None)
    return best if best and not _OTHER.match(words, best[1]) else None


def _full(version: str, versions: tuple[str, ...]) -> str | None:
    version = version if "." in version else f"{version}.0"
    return version if version in versions else None


def named(words: str, at: int = 0) -> tuple[str, int] | None:
    """The licences that are named one after the other, as "A OR B" or "A AND B"."""
    if not (one := name_at(words, at)):
        return None
    name, end = one
    while (m := _AND.match(words, end)) and (more := name_at(words, m.end())):
        name, end = f"{name} {m[0].split()[0].upper()} {more[0]}", more[1]
    return name, end


def noticed(words: str) -> str | None:
    """The licence of a sentence that puts something under it."""
    if (m := _FORM.match(words)) and (found := named(words, m.end())):
        return found[0]
    return None


def tagged(words: str) -> str | None:
    """The licence that the whole value of a tag names."""
    found = named(words)
    return found[0] if found and found[1] == len(words) else None
