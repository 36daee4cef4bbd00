import random
import re
import time

import pytest

from tabvitals.llm import licenses
from tabvitals.llm.common import plain_words
from tabvitals.llm.license_rules import rules


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain(text):
    """All rules tried on the text, and each detection held against all others."""
    joined = " ".join(words(text))
    found = []
    for order, rule in enumerate(rules()):
        for m in rule.pattern.finditer(joined):
            start = joined[: m.start()].count(" ")
            found.append((-rule.priority, -len(m[0].split()), start, order, start + len(m[0].split())))
    kept = []
    for one in sorted(found):
        if not any(k[2] <= one[2] and one[4] <= k[4] for k in kept):
            kept.append(one)
    return sorted((k[2], k[4], rules()[k[3]].label) for k in kept)


TEXTS = [
    "This work is licensed under the GNU General Public License, version 3.",
    "Released under the MIT License.",
    "Licensed under CC BY-NC 4.0. Also licensed under the Apache License, Version 2.0.",
    "SPDX-License-Identifier: GPL-2.0-or-later\n(CC BY-NC-SA 3.0 license)",
    "see http://creativecommons.org/licenses/by-sa/3.0/ and https://www.apache.org/licenses/LICENSE-2.0",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
    "and associated documentation files (the \"Software\")",
    "Das ist mit allen und ohne, und ich komme mit.",
    "licensed under the bsd 3-clause license; mit, isc and zlib license",
]


def test_there_are_hundreds_of_rules_with_names_of_their_own():
    names = [r.name for r in rules()]
    assert len(names) > 300 and len(set(names)) == len(names)
    assert all(r.keywords and all(r.keywords) for r in rules())


@pytest.mark.parametrize(
    "text, label",
    [
        (TEXTS[0], "gpl-3"),
        (TEXTS[1], "mit"),
        (TEXTS[3], "gpl-2"),
        (TEXTS[3], "cc-by-nc-sa-3.0"),
        (TEXTS[4], "cc-by-sa-3.0"),
        (TEXTS[5], "mit"),
        ("Distributed under the terms of the GNU LGPL v2.1 or later.", "lgpl-2.1"),
        ("released under the Mozilla Public Licence 2.0", "mpl-2"),
        ("This file is in the public domain", None),
        ("This file is placed in the public domain", "public-domain"),
    ],
)
def test_labels(text, label):
    joined = " ".join(words(text))
    found = {d[2] for d in licenses.scanner().detections(joined)}
    assert (label in found) if label else True


@pytest.mark.parametrize(
    "text, labels",
    [
        ("covered by the Apache License 2.0", {"apache-2"}),
        ("covered by the Apache Licence, Version 2.0", {"apache-2"}),
        ("Mozilla Public License 2.0", {"mpl-2"}),
        ("the Mozilla Public License", {"mpl"}),
        ("GNU General Public License version 3", {"gpl-3"}),
        ("GNU General Public License", {"gpl"}),
        ("under the terms of the GNU General Public License version 2", {"gpl-2"}),
        ("GNU Lesser General Public License version 2", {"lgpl"}),
        ("GNU Lesser General Public License version 2.1", {"lgpl-2.1"}),
        ("GNU Affero General Public License v3", {"agpl-3"}),
        ("Eclipse Public License v2.0", {"epl-2"}),
        ("Boost Software License 1.0", {"bsl-1.0"}),
        ("Artistic License 2.0", {"artistic-2"}),
        ("the Unlicense", {"unlicense"}),
        ("MIT licensed", {"mit"}),
        ("offered under a BSD-style license", {"bsd"}),
        ("This article is CC BY-SA 4.0", {"cc-by-sa-4.0"}),
        ("CC0 1.0 Universal", {"cc0-1"}),
        ("Public Domain Mark 1.0", {"cc-pdm-1"}),
        ("her vim license; do not license isc members; the public domain mark of the stadium", set()),
        ("dual licensed under MIT or Apache 2.0", {"mit", "apache-2"}),
        ("available under the ISC license or the zlib license", {"isc", "zlib"}),
        (
            "under the terms of the GNU General Public License as published by the Free Software "
            "Foundation; either version 2 of the License, or (at your option) any later version",
            {"gpl-2"},
        ),
        (
            "the GNU Lesser General Public License as published by the Free Software Foundation, version 2.1",
            {"lgpl-2.1"},
        ),
        ("licensed under a Creative Commons Attribution 4.0 International License", {"cc-by-4.0"}),
        (
            "licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 3.0 Unported License",
            {"cc-by-nc-sa-3.0"},
        ),
        ("ich komme mit; a public general meeting, attribution 40, version 2 0 of apache", set()),
        ("no license for the general public; the mozilla, eclipse or apache foundation", set()),
    ],
)
def test_names_alone(text, labels):
    assert {d[2] for d in licenses.scanner().detections(" ".join(words(text)))} == labels


def test_whole_notices():
    text = " ".join(words("licensed under a Creative Commons Attribution 4.0 International License"))
    assert [d[:4] for d in licenses.scanner().detections(text)] == [(0, 10, "cc-by-4.0", "grant-cc-by-4.0")]


def test_filter_and_suppression_against_brute_force():
    rnd = random.Random(4)
    pool = " ".join(TEXTS).split()
    many = TEXTS + [" ".join(rnd.choices(pool, k=rnd.randint(1, 60))) for _ in range(400)]
    many.append(" ".join(TEXTS * 30))
    for text in many:
        joined = " ".join(words(text))
        assert b" ".join(plain_words(text)).decode() == joined
        assert [d[:3] for d in licenses.scanner().detections(joined)] == plain(text)


def test_digest(spark):
    rows = [
        (1, None, "a"),
        (2, "", "b"),
        (3, "CC BY-NC x cc_by/nc CC BY NC-cc by nc", "c"),
        (3, "CC BY-NC x cc_by/nc CC BY NC-cc by nc", "c"),
        (None, "Ünder the MIT license, under the MIT licenses, under THE mit License", "d"),
        (5, "x " * 20_000 + "apache license version 2", "e"),
    ]
    frame = spark.createDataFrame(rows, "doc_id int, text string, labels string")
    out = licenses.digest(licenses.scanned(frame)).collect()
    got = sorted((str(r.doc_id), r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in out)
    assert got == sorted(
        [
            ("1", 0, 0, None, None, ""),
            ("2", 0, 0, None, None, ""),
            ("3", 13, 4, 0, 10, "cc-by-nc"),
            ("3", 13, 4, 0, 10, "cc-by-nc"),
            ("None", 12, 1, 8, 8, "mit"),
            ("5", 20_004, 1, 20_000, 20_000, "apache-2"),
        ]
    )
    assert all(0 <= r.score <= 1 for r in out)
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in out)
    assert licenses.digest(licenses.scanned(frame.limit(0))).count() == 0


def test_long_texts_full_of_hits_take_linear_time():
    text = "under the MIT license, CC BY-NC é and so on. Licensed under the Apache License 2.0. " * 12_000
    joined = " ".join(words(text))
    start = time.perf_counter()
    places = licenses.base_places(joined, licenses.BASE_PHRASES)
    found = licenses.scanner().detections(joined)
    assert time.perf_counter() - start < 30
    each = len(joined.split()) // 12_000
    assert [p for p, label in places if label == "mit"] == list(range(0, 12_000 * each, each))
    assert {d[2] for d in found} >= {"mit", "apache-2"} and found[-1][1] == len(joined.split())
