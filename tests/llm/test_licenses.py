"""The license scan against plain searches: every rule over the whole text, phrases by lists of words."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from tickloom.llm import licenses as scan
from tickloom.llm import queries
from tickloom.llm.license_rules import LICENSES, RULES

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Notice and the labels it must have.
NOTICES = [
    ("Licensed under CC BY-NC 4.0.", "cc-by-nc"),
    ("This work is licensed under the GNU General Public License, version 3.", "gpl-3"),
    ("Licensed under the Apache License, Version 2.0 (the License)", "apache-2"),
    ("Released under the MIT License.", "mit"),
    ("All rights reserved.", "proprietary"),
    ("SPDX-License-Identifier: LGPL-2.1-or-later", "lgpl-2.1"),
    ("// SPDX-License-Identifier: BSD-3-Clause", "bsd-3"),
    ("GNU Lesser General Public License v3", "lgpl-3"),
    ("https://www.gnu.org/licenses/gpl-2.0.html", "gpl-2"),
    ("available under the terms of the Eclipse Public License v2.0", "epl-2"),
    ("https://creativecommons.org/licenses/by-nc-sa/4.0/", "cc-by-nc-sa"),
    ("Creative Commons Attribution-ShareAlike 3.0 Unported License", "cc-by-sa"),
    ("the terms of the Mozilla Public License, v. 2.0", "mpl-2"),
    ("dual licensed under the Boost Software License", "boost-1"),
    ("This is free and unencumbered software released into the public domain.", "unlicense"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted", "bsd"),
    ("Sie kommen mit dem Zug, permit me to limit python", ""),
    ("der Apache und mit ruby under a tree", ""),
]


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text))


def plain_base(words):
    found = []
    for phrase, label in scan.BASE.items():
        size = len(phrase.split())
        found += [(i, label) for i in range(len(words)) if words[i : i + size] == phrase.split()]
    return sorted(found)


def plain_detections(words):
    """All rules over the whole line, and every pair of intervals."""
    line = f" {' '.join(words)} "
    found = {(m.start(), m.end(), r) for r, rule in enumerate(RULES) for m in rule.pattern.finditer(line)}

    def hides(a, b):
        if a == b or not (a[0] <= b[0] and b[1] <= a[1]):
            return False
        if a[:2] == b[:2]:
            return (RULES[a[2]].priority, a[2]) < (RULES[b[2]].priority, b[2])
        return RULES[a[2]].priority <= RULES[b[2]].priority

    kept = [b for b in found if not any(hides(a, b) for a in found)]
    return sorted((line.count(" ", 0, a) - 1, line.count(" ", a, b) + 1, r) for a, b, r in kept)


def check(text):
    words, base, found = scan.scan_text(text)
    plain = words_of(text)
    assert words == len(plain)
    assert sorted(base) == plain_base(plain)
    assert sorted(map(tuple, found)) == plain_detections(plain)


def test_rules_are_many_and_gated():
    assert len(RULES) > 300 and len({r.name for r in RULES}) == len(RULES)
    assert all(r.gates for r in RULES)


@pytest.mark.parametrize("notice, labels", NOTICES)
def test_notices(spark, notice, labels):
    check(notice)
    docs = spark.createDataFrame([(1, notice)], "doc_id long, text string")
    row = scan.license_labels(scan.scan_licenses(docs)).first()
    assert row.labels == labels and (row.score > 0) == bool(labels)


def test_random_texts_equal_plain_searches():
    rng = random.Random(5)
    pieces = [n for n, _ in NOTICES] + [phrase for phrase in scan.BASE]
    for _, names, identifier, address, gates in LICENSES:
        pieces += [re.sub(r"[^a-z0-9 ]+", " ", t) for t in (names, identifier, address) if t] + list(gates)
    pieces += ["licensed under", "license", "under the terms of the", "version 2.0", "or later", "of the", "Lizenz mit", "\n\n", "é日本", "x" * 300]
    for _ in range(150):
        check(rng.choice([" ", ", ", "-"]).join(rng.choices(pieces, k=rng.randint(1, 25))))


def test_a_distant_gate_changes_nothing():
    filler = "lorem ipsum " * 4000
    check(f"{filler}Released under the MIT License. {filler}mit {filler}licensed under the terms of the GPL v2 {filler}")


def test_query_equals_plain_form(spark):
    rows = {r.doc_id: r for r in queries.QUERIES["op11_licenses"](spark, FOLDER).collect()}
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert rows.keys() == texts.keys()
    for key, text in texts.items():
        words, row = words_of(text), rows[key]
        base, found = plain_base(words), plain_detections(words)
        assert (row.n_words, row.n_base) == (len(words), len(base))
        assert (row.first_word, row.last_word) == ((base[0][0], base[-1][0]) if base else (None, None))
        own = {label for _, label in base}
        assert row.base_labels == ",".join(sorted(own))
        labels = own | {RULES[r].label for _, _, r in found}
        assert row.labels == ",".join(sorted(labels))
        doubt = 1.0
        for label in labels:
            sure = [RULES[r].confidence for _, _, r in found if RULES[r].label == label]
            doubt *= 1 - max(sure + [scan.BASE_CONFIDENCE] * (label in own))
        assert row.score == pytest.approx(1 - doubt) and 0 <= row.score <= 1


def test_edges(spark):
    ddl = "doc_id long, text string, label string, base int, key int, first_word int"
    long = "word and " * 400_000 + "Under the MIT license. " * 3
    texts = [None, "", " \t\n", "x", long, "CC BY NC cc by nc", "CC BY NC cc by nc"]
    docs = spark.createDataFrame([(i if i < 6 else 5, t, "clash", 1, 2, 3) for i, t in enumerate(texts)] + [(None, "mit license", "", 0, 0, 0)], ddl)
    rows = scan.license_labels(scan.scan_licenses(docs)).collect()
    assert len(rows) == 8 and rows[0].asDict() == {
        "doc_id": 0, "n_words": 0, "n_base": 0, "first_word": None, "last_word": None, "base_labels": "", "labels": "", "score": 0.0,
    }
    found = {r.doc_id: r for r in rows}
    assert (found[4].n_words, found[4].n_base, found[4].first_word, found[4].last_word) == (800_012, 3, 800_000, 800_008)
    assert [(r.n_base, r.first_word, r.last_word) for r in rows if r.doc_id == 5] == [(2, 0, 3)] * 2
    assert found[None].labels == "mit" and found[None].n_base == 0
    empty = scan.license_labels(scan.scan_licenses(docs.where(F.lit(False))))
    assert empty.collect() == [] and "score" in empty.columns
