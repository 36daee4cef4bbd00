"""The signature rules of the licence scan, in order.

Patterns are matched against the words of a text, lower-cased and joined by single spaces, so
"Apache License, Version 2.0" is "apache license version 2 0". Every licence below is written by
hand: its label, the words of its name as a pattern, its SPDX identifier and, if it has one, the
words of its address. The forms in which names are used make several rules of each.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cache

V = r"(?:v|version)? ?"

#: label, pattern of the name, SPDX identifier as words, address as words
LICENSES = [
    ("mit", r"(?:the )?(?:mit|expat)(?: x11)?", "mit", "opensource org licenses mit"),
    ("mit-0", r"mit no attribution|mit 0", "mit 0", ""),
    ("apache-2", rf"(?:the )?(?:apache|asl)(?: software)?(?: license)? {V}2(?: 0)?", "apache 2 0",
     "apache org licenses license 2 0"),
    ("apache-1.1", rf"(?:the )?apache(?: software)?(?: license)? {V}1 1", "apache 1 1",
     "apache org licenses license 1 1"),
    ("apache-1.0", rf"(?:the )?apache(?: software)?(?: license)? {V}1 0", "apache 1 0",
     "apache org licenses license 1 0"),
    ("bsd-2-clause", r"(?:the )?(?:simplified|freebsd|2 clause|two clause) bsd|bsd 2 clause",
     "bsd 2 clause", "opensource org licenses bsd 2 clause"),
    ("bsd-3-clause",
     r"(?:the )?(?:new|modified|revised|3 clause|three clause) bsd|bsd 3 clause|bsd new",
     "bsd 3 clause", "opensource org licenses bsd 3 clause"),
    ("bsd-4-clause", r"(?:the )?(?:original|4 clause|four clause) bsd|bsd 4 clause",
     "bsd 4 clause", ""),
    ("bsd-0-clause", r"(?:the )?(?:zero clause|0 clause) bsd|bsd zero clause|0bsd", "0bsd", ""),
    ("bsd", r"(?:the )?bsd(?: style| type)?", "bsd", "opensource org licenses bsd"),
    ("gpl-1", rf"(?:the )?(?:gnu )?(?:general public license|gpl),? ?{V}1(?: 0)?",
     r"gpl 1 0(?: only| or later)?", "gnu org licenses gpl 1 0"),
    ("gpl-2", rf"(?:the )?(?:gnu )?(?:general public licen[cs]e|gpl) ?{V}2(?: 0)?",
     r"gpl 2 0(?: only| or later)?", "gnu org licenses gpl 2 0"),
    ("gpl-3", rf"(?:the )?(?:gnu )?(?:general public licen[cs]e|gpl) ?{V}3(?: 0)?",
     r"gpl 3 0(?: only| or later)?", "gnu org licenses gpl 3 0"),
    ("gpl", r"(?:the )?(?:gnu (?:gpl|general public licen[cs]e)|gpl)", "gpl",
     "gnu org licenses gpl"),
    ("lgpl-2", rf"(?:the )?(?:gnu )?(?:library general public licen[cs]e|lgpl) ?{V}2(?: 0)?",
     r"lgpl 2 0(?: only| or later)?", "gnu org licenses lgpl 2 0"),
    ("lgpl-2.1", rf"(?:the )?(?:gnu )?(?:lesser general public licen[cs]e|lgpl) ?{V}2 1",
     r"lgpl 2 1(?: only| or later)?", "gnu org licenses lgpl 2 1"),
    ("lgpl-3", rf"(?:the )?(?:gnu )?(?:lesser general public licen[cs]e|lgpl) ?{V}3(?: 0)?",
     r"lgpl 3 0(?: only| or later)?", "gnu org licenses lgpl 3 0"),
    ("lgpl", r"(?:the )?(?:gnu )?(?:lesser general public licen[cs]e|lgpl)", "lgpl",
     "gnu org licenses lgpl"),
    ("agpl-1", rf"(?:the )?affero general public licen[cs]e ?{V}1(?: 0)?|agpl ?{V}1(?: 0)?",
     r"agpl 1 0(?: only| or later)?", ""),
    ("agpl-3",
     rf"(?:the )?(?:gnu )?(?:affero general public licen[cs]e|affero gpl|agpl) ?{V}3(?: 0)?",
     r"agpl 3 0(?: only| or later)?", "gnu org licenses agpl 3 0"),
    ("agpl", r"(?:the )?(?:gnu )?(?:affero general public licen[cs]e|affero gpl|agpl)", "agpl",
     "gnu org licenses agpl"),
    ("gfdl-1.2", rf"(?:the )?(?:gnu )?(?:free documentation licen[cs]e|gfdl|fdl) ?{V}1 2",
     r"gfdl 1 2(?: only| or later)?", "gnu org licenses fdl 1 2"),
    ("gfdl-1.3", rf"(?:the )?(?:gnu )?(?:free documentation licen[cs]e|gfdl|fdl) ?{V}1 3",
     r"gfdl 1 3(?: only| or later)?", "gnu org licenses fdl 1 3"),
    ("gfdl", r"(?:the )?(?:gnu )?free documentation licen[cs]e|gfdl", "gfdl",
     "gnu org copyleft fdl"),
    ("mpl-1.1", rf"(?:the )?(?:mozilla public licen[cs]e|mpl) ?{V}1 1", "mpl 1 1",
     "mozilla org mpl 1 1"),
    ("mpl-2", rf"(?:the )?(?:mozilla public licen[cs]e|mpl) ?{V}2(?: 0)?", "mpl 2 0",
     "mozilla org mpl 2 0"),
    ("mpl", r"(?:the )?mozilla public licen[cs]e|mpl", "mpl", "mozilla org mpl"),
    ("epl-1", rf"(?:the )?(?:eclipse public licen[cs]e|epl) ?{V}1(?: 0)?", "epl 1 0",
     "eclipse org legal epl v10"),
    ("epl-2", rf"(?:the )?(?:eclipse public licen[cs]e|epl) ?{V}2(?: 0)?", "epl 2 0",
     "eclipse org legal epl 2 0"),
    ("edl-1", rf"(?:the )?eclipse distribution licen[cs]e ?{V}1(?: 0)?", "",
     "eclipse org org documents edl v10"),
    ("cddl-1.0", rf"(?:the )?(?:common development and distribution licen[cs]e|cddl) ?{V}1(?: 0)?",
     "cddl 1 0", "opensource org licenses cddl 1 0"),
    ("cddl-1.1", rf"(?:the )?(?:common development and distribution licen[cs]e|cddl) ?{V}1 1",
     "cddl 1 1", ""),
    ("cpl-1", rf"(?:the )?(?:common public licen[cs]e|cpl) ?{V}1(?: 0)?", "cpl 1 0", ""),
    ("ipl-1", rf"(?:the )?ibm public licen[cs]e(?: {V}1(?: 0)?)?", "ipl 1 0", ""),
    ("eupl-1.1", rf"(?:the )?(?:european union public licen[cs]e|eupl) ?{V}1 1", "eupl 1 1", ""),
    ("eupl-1.2", rf"(?:the )?(?:european union public licen[cs]e|eupl) ?{V}1 2", "eupl 1 2", ""),
    ("ms-pl", r"(?:the )?microsoft public licen[cs]e|ms pl", "ms pl", ""),
    ("ms-rl", r"(?:the )?microsoft reciprocal licen[cs]e|ms rl", "ms rl", ""),
    ("artistic-1", rf"(?:the )?(?:perl )?artistic licen[cs]e(?: {V}1(?: 0)?)?", "artistic 1 0", ""),
    ("artistic-2", rf"(?:the )?artistic licen[cs]e {V}2(?: 0)?", "artistic 2 0",
     "opensource org licenses artistic license 2 0"),
    ("bsl-1.0", rf"(?:the )?boost software licen[cs]e(?: {V}1(?: 0)?)?", "bsl 1 0",
     "boost org license 1 0"),
    ("busl-1.1", rf"(?:the )?business source licen[cs]e(?: {V}1(?: 1)?)?", "busl 1 1", ""),
    ("elastic-2", rf"(?:the )?elastic licen[cs]e(?: {V}2(?: 0)?)?", "elastic 2 0", ""),
    ("sspl-1", rf"(?:the )?server side public licen[cs]e(?: {V}1)?|sspl", "sspl 1 0", ""),
    ("isc", r"(?:the )?isc", "isc", "opensource org licenses isc"),
    ("zlib", r"(?:the )?zlib(?: libpng)?", "zlib", "opensource org licenses zlib"),
    ("libpng", r"(?:the )?libpng", "libpng", ""),
    ("x11", r"(?:the )?x11", "x11", ""),
    ("ncsa", r"(?:the )?(?:university of illinois )?ncsa(?: open source)?", "ncsa", ""),
    ("openssl", r"(?:the )?openssl", "openssl", "openssl org source license"),
    ("psf-2", rf"(?:the )?(?:python software foundation|psf)(?: licen[cs]e)?(?: {V}2(?: 0)?)?",
     r"(?:psf|python) 2 0", "python org psf license"),
    ("php-3", rf"(?:the )?php(?: licen[cs]e)? {V}3(?: 0)?", "php 3 0", "php net license 3 0"),
    ("php-3.01", rf"(?:the )?php(?: licen[cs]e)? {V}3 01", "php 3 01", "php net license 3 01"),
    ("ruby", r"(?:the )?ruby", "ruby", "ruby lang org en about license"),
    ("wtfpl", r"(?:the )?wtfpl|do what the fuck you want to public licen[cs]e", "wtfpl",
     "wtfpl net"),
    ("unlicense", r"(?:the )?unlicense", "unlicense", "unlicense org"),
    ("vim", r"(?:the )?vim", "vim", ""),
    ("postgresql", r"(?:the )?postgresql", "postgresql", "postgresql org about licence"),
    ("upl-1", rf"(?:the )?universal permissive licen[cs]e(?: {V}1(?: 0)?)?", "upl 1 0", ""),
    ("osl-3", rf"(?:the )?open software licen[cs]e {V}3(?: 0)?", "osl 3 0", ""),
    ("afl-3", rf"(?:the )?academic free licen[cs]e {V}3(?: 0)?", "afl 3 0", ""),
    ("qpl-1", rf"(?:the )?q public licen[cs]e(?: {V}1(?: 0)?)?", "qpl 1 0", ""),
    ("ofl-1.1", rf"(?:the )?(?:sil )?open font licen[cs]e(?: {V}1 1)?", "ofl 1 1",
     "scripts sil org ofl"),
    ("odbl-1", rf"(?:the )?open (?:data commons open )?database licen[cs]e|odbl(?: {V}1(?: 0)?)?",
     "odbl 1 0", "opendatacommons org licenses odbl"),
    ("odc-by-1", r"(?:the )?open data commons attribution|odc by", "odc by 1 0",
     "opendatacommons org licenses by"),
    ("pddl-1", r"(?:the )?public domain dedication and licen[cs]e|pddl", "pddl 1 0",
     "opendatacommons org licenses pddl"),
    ("cc0-1", rf"(?:the )?(?:cc0|creative commons zero)(?: {V}1(?: 0)?)?(?: universal)?",
     "cc0 1 0", "creativecommons org publicdomain zero 1 0"),
    ("cc-pdm-1", r"(?:the )?(?:creative commons )?public domain mark", "",
     "creativecommons org publicdomain mark 1 0"),
    ("openrail", r"(?:the )?(?:bigscience |creativeml )?open ?rail(?: m)?", "", ""),
    ("llama-2", r"(?:the )?llama 2 community", "", ""),
    ("llama-3", r"(?:the )?(?:meta )?llama 3(?: \d)? community", "", ""),
]

_CC_PARTS = [
    ("cc-by-nc-nd", r"cc by nc nd|(?:creative commons )?attribution non ?commercial no ?deriv\w*",
     "by nc nd"),
    ("cc-by-nc-sa", r"cc by nc sa|(?:creative commons )?attribution non ?commercial share ?alike",
     "by nc sa"),
    ("cc-by-nd", r"cc by nd|(?:creative commons )?attribution no ?deriv\w*", "by nd"),
    ("cc-by-sa", r"cc by sa|(?:creative commons )?attribution share ?alike", "by sa"),
    ("cc-by-nc", r"cc by nc|(?:creative commons )?attribution non ?commercial", "by nc"),
    ("cc-by", r"cc by|creative commons attribution", "by"),
]
_CC_VERSIONS = ["1 0", "2 0", "2 5", "3 0", "4 0"]

#: label, words that any such text has, words of the licence's own text
TEXTS = [
    (
        "mit",
        "hereby granted",
        "permission is hereby granted free of charge to any person obtaining a copy "
        "of this software and associated documentation files",
    ),
    (
        "mit",
        "permission notice shall",
        "the above copyright notice and this permission notice shall be included in "
        "all copies or substantial portions of the software",
    ),
    (
        "isc",
        "hereby granted",
        "permission to use copy modify and or distribute this software for any "
        "purpose with or without fee is hereby granted(?: provided)?",
    ),
    (
        "bsd",
        "redistribution and use",
        "redistribution and use in source and binary forms with or without "
        "modification are permitted",
    ),
    (
        "bsd-3-clause",
        "endorse or promote",
        "neither the names? of .{1,80}? nor the names of its contributors may be "
        "used to endorse or promote products",
    ),
    (
        "bsd-4-clause",
        "advertising materials",
        "all advertising materials mentioning features or use of this software must "
        "display the following acknowledgement",
    ),
    (
        "zlib",
        "express or implied",
        "this software is provided as is without any express or implied warranty in "
        "no event will the authors be held liable",
    ),
    (
        "zlib",
        "altered source",
        "altered source versions must be plainly marked as such and must not be "
        "misrepresented as being the original software",
    ),
    (
        "gpl-2",
        "as published by",
        "(?:the )?gnu general public licen[cs]e as published by the free "
        "software foundation (?:either )?version 2(?: of the licen[cs]e)?",
    ),
    (
        "gpl-3",
        "as published by",
        "(?:the )?gnu general public licen[cs]e as published by the free "
        "software foundation (?:either )?version 3(?: of the licen[cs]e)?",
    ),
    (
        "lgpl-2",
        "as published by",
        "(?:the )?gnu library general public licen[cs]e as published by the free "
        "software foundation (?:either )?version 2(?: of the licen[cs]e)?",
    ),
    (
        "lgpl-2.1",
        "as published by",
        "(?:the )?gnu lesser general public licen[cs]e as published by the free "
        "software foundation (?:either )?version 2 1(?: of the licen[cs]e)?",
    ),
    (
        "lgpl-3",
        "as published by",
        "(?:the )?gnu lesser general public licen[cs]e as published by the free "
        "software foundation (?:either )?version 3(?: of the licen[cs]e)?",
    ),
    (
        "agpl-3",
        "as published by",
        "(?:the )?gnu affero general public licen[cs]e as published by the free "
        "software foundation (?:either )?version 3(?: of the licen[cs]e)?",
    ),
    (
        "gpl",
        "this program is free",
        "this program is free software you can redistribute it and or modify it "
        "under the terms of the gnu general public license",
    ),
    (
        "lgpl",
        "this library is free",
        "this library is free software you can redistribute it and or modify it "
        "under the terms of the gnu (?:lesser|library) general public license",
    ),
    (
        "agpl",
        "affero",
        "it under the terms of the gnu affero general public license",
    ),
    (
        "gpl",
        "general public license along",
        "you should have received a copy of the gnu general public license along "
        "with this program",
    ),
    (
        "lgpl",
        "lesser general public",
        "you should have received a copy of the gnu lesser general public license "
        "along",
    ),
    (
        "apache-2",
        "in compliance with the license",
        "you may not use this file except in compliance with the license you may "
        "obtain a copy of the license at",
    ),
    (
        "mpl-2",
        "source code form",
        "this source code form is subject to the terms of the mozilla public license "
        "v 2 0",
    ),
    (
        "unlicense",
        "unencumbered",
        "this is free and unencumbered software released into the public domain",
    ),
    (
        "bsl-1.0",
        "hereby granted",
        "permission is hereby granted free of charge to any person or organization "
        "obtaining a copy of the software and accompanying documentation covered by "
        "this license",
    ),
    (
        "wtfpl",
        "verbatim or modified",
        "everyone is permitted to copy and distribute verbatim or modified copies of "
        "this license document and changing it is allowed",
    ),
    (
        "ofl-1.1",
        "font software",
        "this font software is licensed under the sil open font license",
    ),
    (
        "cc0-1",
        "waived all",
        "to the extent possible under law the (?:person|author)s? .{0,80}?waived all "
        "copyright and related or neighboring rights",
    ),
    (
        "public-domain",
        "public domain",
        "(?:this|the) (?:work|file|code|software|document|text) is (?:hereby "
        ")?(?:placed |released |dedicated )?(?:in|into|to) the public domain",
    ),
    (
        "public-domain",
        "public domain",
        "dedicated to the public domain",
    ),
    (
        "all-rights-reserved",
        "all rights reserved",
        "all rights reserved",
    ),
    (
        "proprietary",
        "proprietary",
        "proprietary and confidential",
    ),
    (
        "proprietary",
        "unauthorized copying",
        "unauthorized copying of this (?:file|work)",
    ),
]

_GRANT = (
    r"(?:re)?(?:licen[cs]ed|released|distributed|available|published|provided|issued|offered)"
    r"(?: to you)? under (?:the |an? )?(?:terms (?:and conditions )?of (?:the |an? )?)?"
)
#: Further names that a grant lists: "under MIT or Apache 2.0".
_LISTED = rf"{_GRANT}(?:\w+ ){{1,8}}?(?:or|and) (?:the )?"
#: Names that are words or programs as well; "license" beside them says nothing.
_COMMON_WORDS = {"isc", "ruby", "vim"}
_AFTER = r"(?: (?:or (?:\(at your option\) )?(?:any )?later|only))?(?: licen[cs]e)?"


@dataclass(frozen=True)
class Rule:
    """One signature; it is tried on texts that have a keyword of each group."""

    name: str
    label: str
    pattern: re.Pattern
    keywords: tuple[frozenset[str], ...]
    priority: int
    score: float


def _literals(pattern: str) -> frozenset[str]:
    """Words of a pattern outside of optional groups; a match has at least one of them."""
    before = ""
    while before != pattern:
        before, pattern = pattern, re.sub(r"\(\?:[^()]*\)\?", " ", pattern)
    found = re.findall(r"(?<!\\)[a-z0-9]{2,}", re.sub(r"\[\w+\]|\(\?:|\\\w[*+]?", " ", pattern))
    return frozenset(found) - {"the"}


def _split(pattern: str) -> tuple[list[str], list[str]]:
    """The alternatives of a pattern, and the groups and single characters of the first."""
    branches, parts, depth = [""], [""], 0
    for c in pattern:
        depth += (c == "(") - (c == ")")
        if c == "|" and not depth:
            branches.append("")
            continue
        branches[-1] += c
        if len(branches) == 1:
            parts[-1] += c
            if not depth:
                parts.append("")
    return branches, parts[:-1]


def _spelled_out(pattern: str) -> str:
    """The pattern as far as its matches hold the word licence themselves."""
    out = []
    for branch in _split(pattern)[0]:
        if "licen" not in branch:
            continue
        _, parts = _split(branch)
        for i, part in enumerate(parts):
            if part.startswith("(?:") and "licen" in part:
                parts[i] = f"(?:{_spelled_out(part[3:-1])})"
                if parts[i + 1 : i + 2] == ["?"]:
                    parts[i + 1] = ""
        out.append("".join(parts))
    return "|".join(out).replace("license", "licen[cs]e")


def _rule(
    name: str, label: str, pattern: str, keywords: list[frozenset[str]], priority: int, score: float
) -> Rule:
    compiled = re.compile(rf"(?<![^ ])(?:{pattern})(?![^ ])")
    return Rule(name, label, compiled, tuple(keywords), priority, score)


def _named() -> list[tuple[str, str, str, str]]:
    rows = list(LICENSES)
    for label, name, tail in _CC_PARTS:
        for version in _CC_VERSIONS:
            number = version.replace(" ", ".")
            rows.append(
                (
                    f"{label}-{number}",
                    rf"(?:{name})(?: \w+)? {version}(?: (?:international|unported))?",
                    f"cc {tail} {version}",
                    f"creativecommons org licenses {tail} {version}",
                )
            )
        rows.append((label, name, f"cc {tail}", f"creativecommons org licenses {tail}"))
    return rows


#: Names of others that the name of the GPL ends.
_NO_OTHER = "(?<!lesser )(?<!library )(?<!affero )"
_CC_VERSION = re.compile(r"cc-by.*-(\d)\.(\d)")


def _bare(label: str, name: str) -> Rule | None:
    """The rule of a name that needs no word beside it: it holds 'licence', or is one of CC."""
    if version := _CC_VERSION.fullmatch(label):
        keys = [frozenset(["cc by", "attribution"]), frozenset([f" {version[1]} {version[2]}"])]
    elif label == "cc0-1":
        keys = [frozenset(["cc0", "creative commons zero"])]
    elif label == "cc-pdm-1":
        keys = [frozenset(["public domain mark"])]
        name = "(?:the )?(?:creative commons public domain mark|public domain mark 1 0)(?: 1 0)?"
    elif "licen" in name:
        name = _spelled_out(name)
        licen = frozenset(["licen"])
        keys = [licen, _literals(name) - licen]
    else:
        return None
    return _rule(f"bare-{label}", label, rf"{_NO_OTHER}(?:{name})", keys, 5, 0.6)


@cache
def rules() -> list[Rule]:
    """All rules. Own texts come first, then tags, addresses, grants, and names.

    A name needs a word like "license" beside it, unless it holds that word or is one of CC with
    its version.
    """
    out = [
        _rule(f"text-{i}", label, words, [frozenset([key])], 50, 0.95)
        for i, (label, key, words) in enumerate(TEXTS)
    ]
    licen = frozenset(["licen"])
    for label, name, spdx, address in _named():
        if spdx:
            tag = rf"spdx license identifier (?:{spdx})"
            out.append(_rule(f"tag-{label}", label, tag, [frozenset(["spdx"])], 40, 1.0))
        if address:
            site = frozenset([" ".join(address.split()[:2])])
            out.append(_rule(f"address-{label}", label, address, [site], 30, 0.9))
        granted = rf"{_GRANT}(?:{name}){_AFTER}"
        words = _literals(name)
        keys = [frozenset([" under "]), words]
        out.append(_rule(f"grant-{label}", label, granted, keys, 20, 0.85))
        listed = rf"{_LISTED}(?:{name}){_AFTER}"
        out.append(_rule(f"list-{label}", label, listed, keys, 15, 0.75))
        called = rf"(?:{name}) licen[cs]ed?|licen[cs]e (?:is )?(?:the )?(?:{name})"
        if label not in _COMMON_WORDS:
            out.append(_rule(f"name-{label}", label, called, [licen, words], 10, 0.7))
        if bare := _bare(label, name):
            out.append(bare)
    return out
