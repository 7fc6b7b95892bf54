import re

import cases
import pytest
from strata.llm import licenses, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

TEXTS = [
    "Released under the MIT License.",
    "mit license MIT-License; mit\nlicense",
    "GNU General Public License GNU GENERAL PUBLIC LICENSE, version 3. Apache-License",
    "cc by cc by 4.0 and cc  by",
    "gnu general public licenses, emit license, mit éicense",
    "SPDX-License-Identifier: GPL-2.0-or-later",
    "Licensed under the Apache License, Version 2.0 (the \"License\")",
    "gnu lesser general public license v2.1; All rights reserved.",
    "Permission is hereby granted, free of charge, to any person obtaining a copy",
]

BROKEN = [
    "GNU Lesser General\nPublic License, version 2.1",
    "the Mozilla Public\n  License",
    "all rights\r\nreserved",
    "permission is hereby granted, free of\ncharge, to any person obtaining\ta copy",
    "Redistribution\nand use in source and binary forms, with or\nwithout modification, are permitted",
    "Eclipse\n\nPublic\tLicense",
    "placed into the public\ndomain",
]


def brute(text):
    words = WORD.findall((text or "").translate(LOWER))
    places = []
    for i in range(len(words)):
        for label, phrase in licenses.PHRASES.items():
            if words[i : i + len(phrase)] == phrase:
                places.append((i, label))
    at = [i for i, _ in places]
    return len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


@pytest.mark.parametrize("source", ["driver", "edge", "written"])
def test_base_against_brute_force(spark, tmp_path, source):
    docs = {"driver": cases.driver_docs, "edge": cases.edge_docs, "written": lambda s: cases.docs(s, TEXTS)}[source](spark)
    folder = cases.written(spark, tmp_path, documents=docs)
    rows = queries.QUERIES["op7_licenses"](spark, folder).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows), key=repr)
    assert got == sorted(((r.doc_id, *brute(r.text)) for r in docs.select("doc_id", "text").collect()), key=repr)
    for r in rows:
        assert 0 <= r.score <= 1
        assert not r.base_labels or set(r.base_labels.split(",")) <= set(r.labels.split(","))


def test_longer_and_prior_detections_win(spark):
    found = {r.doc_id: [(d.label, d.start, d.end) for d in r.detections] for r in licenses.scan(cases.docs(spark, TEXTS)).collect()}
    assert found[5] == [("gpl", 0, 41)]
    assert [x[0] for x in found[6]] == ["apache", "apache-2.0"]
    assert [x[0] for x in found[7]] == ["lgpl-2.1", "proprietary"]
    assert [x[0] for x in found[8]] == ["mit"]
    assert [x[0] for x in found[1]] == ["mit", "mit"]


def brute_hits(text):
    low = text.lower()
    hits = []
    for _, pattern, label, priority, _ in licenses.signature_rules():
        hits += [(m.start(), m.end(), priority, label) for m in re.finditer(pattern, low, re.ASCII)]
    kept, end = [], -1
    for h in sorted(hits, key=lambda h: (h[0], -h[1], -h[2], h[3])):
        if h[1] > end:
            kept.append(h)
            end = h[1]
    return kept


def test_detections_against_ungated_brute_force(spark):
    texts = TEXTS + BROKEN + [" x\n".join(TEXTS), "é " + " ".join(TEXTS[::-1]) + " ü"]
    for r in licenses.scan(cases.docs(spark, texts)).collect():
        assert [(d.start, d.end, d.priority, d.label) for d in r.detections] == brute_hits(texts[r.doc_id])


def test_names_broken_over_lines_are_found(spark):
    found = {r.doc_id: [d.label for d in r.detections] for r in licenses.scan(cases.docs(spark, BROKEN)).collect()}
    assert found == {0: ["lgpl-2.1"], 1: ["mpl"], 2: ["proprietary"], 3: ["mit"], 4: ["bsd"], 5: ["epl"], 6: ["public-domain"]}


def test_rules(spark):
    rules = licenses.signature_rules()
    assert len(rules) > 300
    gate = licenses.gate_words(rules)
    for keyword, pattern, *_ in rules:
        re.compile(pattern)
        assert any(w in keyword for w in gate)


def test_empty_table_and_no_python(spark):
    assert licenses.scan(cases.empty_docs(spark)).collect() == []
    plan = licenses.scan(cases.driver_docs(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
