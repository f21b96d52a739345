import math
import re

import pytest

from tiersmith.llm import licence_scan as scan


@pytest.fixture(scope="module")
def model(spark):
    return scan.train(spark)


def test_notices_of_all_families_are_confirmed(make, model):
    rows = [(i, f"Some prose before.\n{text}\nand after.") for i, (_, text) in enumerate(scan.TEMPLATES)]
    found = {r.doc_id: r for r in scan.licence_paragraphs(make(rows), model).collect()}
    for i, (family, text) in enumerate(scan.TEMPLATES):
        r = found[i]
        assert (r.paragraph, r.begin, r.notice) == (1, 19, text)
        assert r.licence == family and r.confirmed and r.template_share == 1, text


def test_notices_with_other_words(make, model):
    rows = [
        (1, "Unless noted, licensed under the Apache License, Version 2.0, January 2004"),
        (2, "THIS WORK IS LICENSED UNDER THE GNU GENERAL PUBLIC LICENSE, VERSION 3."),
        (3, "This file is released under the MIT License, see below"),
    ]
    found = {r.doc_id: (r.licence, r.confirmed) for r in scan.licence_paragraphs(make(rows), model).collect()}
    assert found == {1: ("Apache-2.0", True), 2: ("GPL-3.0", True), 3: ("MIT", True)}


def test_other_sentences_are_unknown(make, model):
    rows = [
        (1, "My fishing license is at home."),
        (2, "He asked for permission to leave."),
        (3, "A warranty of two years."),
        (4, "The domain of the function is open."),
        (5, "Ein Satz mit dem Wort mit, ohne Lizenz."),
        (6, "Plain text without any such word."),
    ]
    found = {r.doc_id: r for r in scan.licence_paragraphs(make(rows), model).collect()}
    assert found.keys() == {1, 2, 3, 4}
    assert all(r.licence == scan.UNKNOWN and not r.confirmed for r in found.values())
    assert all(0 <= r.probability <= 1 for r in found.values())


MIT_TEXT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:"""
BSD_TEXT = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:"""
GPL_TEXT = """ * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version."""


@pytest.mark.parametrize("around", ["Some prose before.\n{}\n\nand after", "{}", "A title\n\n{}\n \nMore prose."])
def test_wrapped_notices_are_one_paragraph(make, model, around):
    texts = {"MIT": MIT_TEXT, "BSD-3-Clause": BSD_TEXT, "GPL-3.0": GPL_TEXT}
    rows = [(i, around.format(text)) for i, text in enumerate(texts.values())]
    found = scan.licence_paragraphs(make(rows), model).collect()
    got = sorted((r.doc_id, r.licence, r.confirmed, r.notice) for r in found)
    assert got == [(i, family, True, text) for i, (family, text) in enumerate(texts.items())]
    assert all(dict(rows)[r.doc_id][r.begin :].startswith(r.notice) for r in found)
    assert all(r.paragraph == dict(rows)[r.doc_id][: r.begin].count("\n") for r in found)


def test_a_wrapped_version_belongs_to_its_notice(make, model):
    rows = [(v, f"This work is licensed under the GNU General Public License,\nversion {v}.") for v in (2, 3)]
    found = {r.doc_id: (r.licence, r.confirmed) for r in scan.licence_paragraphs(make(rows), model).collect()}
    assert found == {2: ("GPL-2.0", True), 3: ("GPL-3.0", True)}


def test_names_of_all_families(make, model):
    named = [(family, name) for family, names in scan.NAMES for name in names]
    assert {family for family, _ in named} == {family for family, _ in scan.TEMPLATES} - {"Proprietary"}
    forms = ("Available under {}", "Distributed under the {}", "relicensed under {}", "SPDX-License-Identifier: {}")
    wanted = [(family, form.format(name)) for family, name in named for form in forms]
    wanted += [("MIT", "This code is under the MIT terms"), ("BSD-3-Clause", "BSD-3-Clause"), ("MPL-2.0", "MPL-2.0")]
    wanted += [("CC0-1.0", "CC0-1.0"), ("CC-BY-4.0", "Released under CC-BY-4.0")]
    found = {r.doc_id: r for r in scan.licence_paragraphs(make([(i, t) for i, (_, t) in enumerate(wanted)]), model).collect()}
    assert [(found[i].licence, found[i].confirmed) for i in range(len(wanted))] == [(f, True) for f, _ in wanted]
    unsure = scan.licence_paragraphs(make([(1, "You may sublicense it"), (2, "MIT is in Boston"), (3, "Er kam mit")]), model)
    assert sorted((r.doc_id, r.licence) for r in unsure.collect()) == [(1, scan.UNKNOWN), (2, scan.UNKNOWN)]


def test_odd_rows(make, odd_rows, model):
    assert scan.licence_paragraphs(make(odd_rows), model).count() == 0
    notice = "Licensed under CC BY-NC 4.0."
    rows = [(1, notice), (1, notice), (None, notice), (2, "x " * 200_000 + "\n" + notice + "\n" + notice)]
    found = scan.licence_paragraphs(make(rows), model).collect()
    assert [r.licence for r in found] == ["CC-BY-NC-4.0"] * 5
    assert sorted(r.begin for r in found) == [0, 0, 0, 400_001, 400_001 + len(notice) + 1]
    assert scan.licence_paragraphs(make([]), model).count() == 0


def test_no_python_runs_in_tasks(make, model):
    plan = scan.licence_paragraphs(make([(1, "license")]), model)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "MapInArrow"))


def plain_score(model, text):
    """The probability of each class, with lists and loops."""
    words = re.findall(r"[^\W_]+(?:[.-][^\W_]+)*|[.!?](?=\s|$)", text.lower())
    tokens = [".", *("." if w in "!?" else w for w in words), "."]
    names = {name.lower() for _, names in scan.NAMES for name in names}
    grams = set()
    for some in (tokens, ["@" if t in names else t for t in tokens]):
        grams |= {" ".join(some[i : i + n]) for n in (1, 2, 3) for i in range(len(some) - n + 1)}
    logits = list(model.intercepts)
    for gram, weights in model.weights:
        if gram in grams:
            logits = [x + w for x, w in zip(logits, weights, strict=True)]
    odds = [math.exp(x - max(logits)) for x in logits]
    return dict(zip(model.families, [x / sum(odds) for x in odds], strict=True))


def plain_share(family, text):
    pairs = lambda t: {tuple(w[i : i + 2]) for w in [re.findall(r"[^\W_]+(?:[.-][^\W_]+)*", t.lower())] for i in range(max(1, len(w) - 1))}
    return max([len(pairs(t) & pairs(text)) / len(pairs(t)) for f, t in scan.NOTICES if f == family], default=0)


MENTIONS = [
    "He studied under the ISC board.", "This package is not licensed under the GPL-3.0.",
    "The authors, under MIT guidance, wrote it.", "This is not released under the Apache License, Version 2.0.",
    "BSD users met.", "They met under the MIT dome.", "The Mozilla Public License is discussed here.",
    "UND!! DER!! MIT!! EIN!! VON!!",
]


def test_scores_equal_a_plain_version(make, model):
    texts = [t for _, t in scan.NOTICES[::5]] + list(scan.OTHERS) + MENTIONS + ["Dual-licensed under MIT or Apache-2.0.", MIT_TEXT]
    for r in scan.licence_paragraphs(make(list(enumerate(texts))), model).collect():
        odds = plain_score(model, r.notice)
        best = max((f for f in odds if f != scan.UNKNOWN), key=odds.get)
        assert r.licence == (best if 1 - odds[scan.UNKNOWN] >= model.certain else scan.UNKNOWN), r.notice
        assert r.probability == pytest.approx(odds[r.licence], abs=1e-9)
        assert r.template_share == pytest.approx(plain_share(r.licence, r.notice))


def test_a_name_alone_grants_nothing(make, model):
    found = scan.licence_paragraphs(make(list(enumerate(MENTIONS))), model).collect()
    assert [r.notice for r in found if r.licence != scan.UNKNOWN] == []
    assert len(found) == len(MENTIONS) and not any(r.confirmed for r in found)


def test_two_licences_that_are_offered(make, model):
    rows = [(1, "Dual-licensed under MIT or Apache-2.0."), (2, "Released under the MIT License.")]
    found = {r.doc_id: r for r in scan.licence_paragraphs(make(rows), model).collect()}
    assert {found[1].licence, *found[1].also} == {"MIT", "Apache-2.0"} and found[1].confirmed
    assert (found[2].licence, found[2].also) == ("MIT", [])


def test_names_of_kept_columns(spark, model):
    df = spark.createDataFrame([(1, "Released under the MIT License.", 5, 6, 7)], "doc_id long, text string, words int, tokens int, odds int")
    (row,) = scan.licence_paragraphs(df, model).collect()
    assert row.licence == "MIT"
