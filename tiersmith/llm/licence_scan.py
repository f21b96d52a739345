"""Licence notices found by a trained paragraph classifier and confirmed by templates.

A paragraph is a run of lines that go on: it ends at a line without words, at
the end of a sentence that is the end of a line, and on both sides of a line
that holds a whole template by itself. So hard-wrapped notices are one
paragraph, and notices on lines of their own are one each. Its features are its
n-grams of words and sentence marks that hold a licence word, so a paragraph
without any has no feature of any family and needs no score. A multinomial
logistic regression over these sparse features gives each licence family, and
the class of unknown paragraphs, a probability. It is trained on notices of the
families, whole and with words left out, against sentences that use licence
words for other things, that name a licence without granting it, or deny it.

The classifier alone identifies the family: the likeliest one, if all families
together are as certain as unknown paragraphs that a model has not seen hardly
ever are. The templates of that family then confirm it, or do not: it has
most of the word pairs of one of them. What else the classifier holds possible,
as where two licences are offered, is named beside it if a whole notice of that
family stands there too.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UNKNOWN = "unknown"

# Usual notices of licence families.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("LGPL", "This library is licensed under the GNU Lesser General Public License, version 2.1 or later."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Licensed under the ISC License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work under CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "Copyright, all rights reserved. No part of this publication may be reproduced without the prior written permission of the publisher."),
)
# Sentences with licence words that are no notices.
OTHERS = (
    "The driver lost his license after the accident.",
    "A fishing licence is required on this lake.",
    "The licence fee is paid by every household.",
    "The license plate was found near the public library.",
    "Permission denied.",
    "The warranty covers two years, see the conditions.",
    "The general public was asked for permission.",
    "Copyright law differs between countries.",
    "Free software is discussed in this article.",
    "The GNU project began long ago.",
    "The Apache helicopter was released from service.",
    "Mozilla is an organisation in California.",
    "Creative people meet in the commons.",
    "Read the license before you install the software.",
    "Their license expired and the version was withdrawn.",
    "He licensed the song to a film studio.",
    "The redistribution of wealth is a public question.",
    "All rights to vote were reserved for citizens.",
    "Who may use the public domain name?",
    "She studied at MIT.",
    "The license server is down again.",
    "Any copyright notice must be kept.",
    "The rights of the public are protected by law.",
    "A license agreement was signed by both parties.",
    "The creative director granted permission to film.",
    "Permission was granted by the council, free of charge.",
    "Redistribution of income, in whole or in part, is permitted by the state.",
)
# Short names of the families, as notices and package data give them.
NAMES = (
    ("Apache-2.0", ("Apache-2.0",)),
    ("MIT", ("MIT",)),
    ("GPL-3.0", ("GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later", "GPL-3", "GPLv3")),
    ("GPL-2.0", ("GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-2", "GPLv2")),
    ("LGPL", ("LGPL", "LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPLv2.1", "LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later", "LGPLv3")),
    ("AGPL-3.0", ("AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later", "AGPLv3")),
    ("BSD-3-Clause", ("BSD-3-Clause",)),
    ("BSD-2-Clause", ("BSD-2-Clause",)),
    ("MPL-2.0", ("MPL-2.0", "MPLv2")),
    ("ISC", ("ISC",)),
    ("CC-BY-4.0", ("CC-BY-4.0",)),
    ("CC-BY-SA-4.0", ("CC-BY-SA-4.0",)),
    ("CC-BY-NC-4.0", ("CC-BY-NC-4.0",)),
    ("CC0-1.0", ("CC0-1.0", "CC0")),
    ("Unlicense", ("Unlicense",)),
)
_FORMS = ("under {}", "under the {}", "SPDX-License-Identifier: {}", "License: {}")
# What a notice says before such a phrase, and behind the name.
_OPENINGS = ("", "Released ", "Available ", "Distributed ", "Relicensed ", "Licensed ", "This code is ", "All of it is licensed ")
_ENDINGS = ("", " terms", " license", " or later")
# Sentences that name a licence and grant nothing.
_MENTIONS = (
    "This package is not licensed under the {}.", "Not released under {}.", "It was never available under {}.",
    "The code is no longer under the {}.", "He studied under the {} board.", "The authors, under {} guidance, wrote it.",
    "A talk about {} was given.", "They work under a {} group.", "The {} committee met in May.", "Under {} rule it was worse.",
    "She compared {} with other texts.", "What is {} good for?", "The {} campus is large.", "We asked {} people.",
    "Under the {} team it grew.", "Neither under {} nor otherwise.",
)
# Full names, in notices and in sentences that mention or deny them.
_FULL_NAMES = (
    ("Apache-2.0", "Apache License, Version 2.0"), ("MIT", "MIT License"), ("ISC", "ISC License"),
    ("GPL-3.0", "GNU General Public License, version 3"), ("GPL-2.0", "GNU General Public License, version 2"),
    ("LGPL", "GNU Lesser General Public License"), ("AGPL-3.0", "GNU Affero General Public License"),
    ("BSD-3-Clause", "BSD 3-Clause License"), ("BSD-2-Clause", "BSD 2-Clause License"), ("MPL-2.0", "Mozilla Public License"),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International License"),
)
_FULL_NOTICES = (
    "Released under the {}.", "This file is released under the {}, see below", "Licensed under the {}.",
    "The code is available under the {}", "All of it is distributed under the terms of the {}.", "Unless noted, licensed under the {}",
    "It is made available under the {}. See the file for details.", "This project is licensed under the {}.",
    "Released under the {}", "Released by us under the {}. Enjoy.", "Its sources are released under the {}, with examples",
)
_FULL_MENTIONS = (
    "This is not released under the {}.", "The work is not licensed under the {}.", "The {} is discussed here.",
    "She has read the {} twice.", "What does the {} say?", "It was never under the {}.", "A history of the {} was written.",
    "Nothing here is licensed under the {}.",
)
# A short name without a version, by itself among others, is a word.
_BARE = (
    "One! {}! Two!", "ALL. {}! AND. OR", "DER! {}! DIE", "UND!! {}!! EIN!!", "IN {} DER", "VON. {}. DEM", "SIE! DAS! {}! AUF!",
    "ES {}! WAR", "ALS! {} EIN",
)
#: All that confirms a family; a name with a version is a notice by itself.
NOTICES = TEMPLATES + tuple(
    (family, form.format(name))
    for family, names in NAMES
    for name in names
    for form in (*_FORMS, *(["{}"] if "-" in name or name[-1].isdigit() else []))
)
# A word that begins so, or holds "licens" or "licenc" anywhere, is a licence word. Versions may follow.
_BEGINS = (
    "spdx", "gnu", "[al]?gpl", "apache", "mozilla", "mpl", "bsd", "cc0?", "creative", "commons", "copyright(?:s|ed)?",
    "permissions?", "redistribut(?:e|es|ed|ion|ions)", "warrant(?:y|ies)", "unencumbered", "domain", "rights",
)
# In small letters these are words of other languages.
_CAPITALS = ("MIT", "ISC")
# What any of them holds in small letters; for a first look at whole texts.
_STEMS = (
    "licens", "licenc", "spdx", "gnu", "gpl", "apache", "mozilla", "mpl", "bsd", "cc", "creative", "commons", "copyright",
    "permission", "redistribut", "warrant", "unencumbered", "domain", "rights",
)
# Words that count as licence words within a paragraph that has one.
_DENIALS = ("not", "never", "no", "neither", "nothing", "nor")
LONGEST_NGRAM = 3
#: All families together need this probability, or what keeps this share of unknown training paragraphs out if more.
CERTAIN, QUIET = 0.6, 0.92
#: A further family needs this share of the first one's probability.
POSSIBLE = 0.02
#: Share of a template's word pairs that confirm it.
CONFIRMED = 0.7

_ENDS = r"(?=v?\p{N}|(?!\p{L}))"
_ANY_WORD = rf"(?i)licen[sc]|(?<!\p{{L}})(?:{'|'.join(_BEGINS)}|(?-i:{'|'.join(_CAPITALS)})){_ENDS}"
_FEATURE = rf"licen[sc]|^(?:{'|'.join(_BEGINS)}|{'|'.join(_CAPITALS).lower()}){_ENDS}"
#: The end of a line that ends a sentence.
_STOP = r"[.!?][\x22')\]]*\s*$"


def _tokens(text: Column) -> Column:
    """Words, and a point for each mark that ends a sentence; the text begins and ends with one."""
    found = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+(?:[.-][\p{L}\p{N}]+)*|[.!?](?=\s|$)"), F.lit(0))
    framed = F.concat(F.array(F.lit(".")), found, F.array(F.lit(".")))
    return F.transform(framed, lambda t: F.when(t.isin("!", "?"), F.lit(".")).otherwise(t))


def _words(text: Column) -> Column:
    """Lower-case words with inner points and hyphens."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+(?:[.-][\p{L}\p{N}]+)*"), F.lit(0))


def _features(tokens: str) -> Column:
    """N-grams of the tokens, and of the same tokens with any family's short name as ``@``.

    The second kind tells what is said of a licence, whichever it is.
    """
    names = ", ".join(f"'{name.lower()}'" for _, names in NAMES for name in names)
    grams = ", ".join(
        f"filter(transform(sequence(1, greatest(size(w) - {n - 1}, 1)), i -> slice(w, i, {n})), g -> size(g) = {n})"
        for n in range(1, LONGEST_NGRAM + 1)
    )
    marked = f"transform({tokens}, t -> IF(t IN ({names}), '@', t))"
    return F.expr(
        f"array_distinct(flatten(transform(array({tokens}, {marked}), w -> transform(concat({grams}), g -> array_join(g, ' ')))))"
    )


def _pairs(words: str) -> Column:
    return F.expr(
        f"array_distinct(transform(sequence(1, greatest(size({words}) - 1, 1)), i -> array_join(slice({words}, i, 2), ' ')))"
    )


def _rows(spark: SparkSession, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(family).alias("family"), F.lit(text).alias("text")) for family, text in pairs])
    return spark.range(1).select(F.posexplode(rows).alias("number", "row")).select("number", "row.family", "row.text")


@dataclass
class Model:
    """A trained classifier: plain numbers, as many as the templates have n-grams."""

    families: list[str]  # the unknown class first
    intercepts: list[float]
    weights: list[tuple[str, list[float]]]  # of each n-gram, by family
    certain: float


def _examples(families: Sequence[str]) -> tuple[list[tuple[str, str]], list[str]]:
    """Notices that name a family by its short name, and sentences that only mention it."""
    notices, mentions = [], []
    for number, (family, names) in enumerate(NAMES):
        if family not in families:
            continue
        for i, name in enumerate(names):
            for j, form in enumerate(_FORMS):
                # Every form and every opening and ending with some of the names.
                for k, opening in enumerate(_OPENINGS):
                    if (i + j + k + number) % 4 == 0 or not opening or len(names) <= 2:
                        for ending in ("", _ENDINGS[(i + k + number) % len(_ENDINGS)]) if form.startswith("under") else ("",):
                            notices.append((family, (opening + form if form.startswith("under") else form).format(name) + ending))
            if "-" in name or name[-1].isdigit():
                notices.append((family, name))
            other, others = NAMES[(number + i + 1) % len(NAMES)]
            if other in families:
                # Of two that are offered the first is the label; the other one is found beside it.
                offered = ("Dual-licensed under {} or {}.", "Available under {} or {}", "Licensed under either {} or {} at your option")
                notices += [(family, text.format(name, others[0])) for text in offered]
            mentions += [text.format(name) for m, text in enumerate(_MENTIONS) if i == 0 or (i + m) % 4 == 0]
        if not any("-" in name or name[-1].isdigit() for name in names):
            mentions += [text.format(name) for name in names for text in _BARE]
    for family, name in _FULL_NAMES:
        notices += [(family, text.format(name)) for text in _FULL_NOTICES if family in families]
        mentions += [text.format(name) for text in _FULL_MENTIONS]
    return list(dict.fromkeys(notices)), mentions


def train(
    spark: SparkSession, templates: Sequence[tuple[str, str]] = TEMPLATES, others: Sequence[str] = OTHERS
) -> Model:
    """Learn the families of ``templates`` against ``others``.

    Notices with the families' short names, and sentences that mention these
    without granting anything, are made from forms and added to both. Every
    training paragraph is used whole, and templates and others also with every
    sixth word left out, from each place on. Two models trained without a fifth
    of the unknown paragraphs tell how sure a model gets of one it has not seen;
    the certainty asked for (that it is a notice of any family) is above that of 92 in a hundred.
    """
    families = [UNKNOWN, *sorted({family for family, _ in templates})]
    notices, mentions = _examples(families)
    whole = [*templates, *[(UNKNOWN, text) for text in others]]
    rows = [*whole, *notices, *[(UNKNOWN, text) for text in mentions]]
    known = spark.createDataFrame([(n, f, t) for n, (f, t) in enumerate(rows)], "number int, family string, text string")
    known = known.withColumn("tokens", _tokens(F.col("text")))
    last = F.when(F.col("number") < len(whole), 5).otherwise(-1)
    variants = known.withColumn("drop", F.explode(F.sequence(F.lit(-1), last))).withColumn(
        "tokens", F.expr("filter(tokens, (w, i) -> drop < 0 OR i % 6 <> drop)")
    )
    label = (F.array_position(F.array(*map(F.lit, families)), F.col("family")) - 1).cast("double")
    ngrams = F.filter(_features("tokens"), lambda g: F.exists(F.split(g, " "), lambda w: w.isin("@", *_DENIALS) | w.rlike(_FEATURE)))
    examples = variants.select("number", "drop", label.alias("label"), ngrams.alias("ngrams"))
    # Some thousand short paragraphs: one task.
    examples = examples.where("size(ngrams) > 0").coalesce(1).cache()
    vectors = CountVectorizer(inputCol="ngrams", outputCol="features", binary=True, minDF=2.0).fit(examples)
    featured = vectors.transform(examples)
    regression = LogisticRegression(family="multinomial", regParam=0.0001, maxIter=60, standardization=False)

    sure: list[float] = []
    for part in range(2):
        held = (F.col("label") == 0) & (F.col("number") % 5 == part)
        partial = regression.fit(featured.where(~held))
        unseen = partial.transform(featured.where(held & (F.col("drop") == -1)))
        any_family = (1 - F.get("p", F.lit(0))).alias("any")
        # One number for each training sentence.
        sure += [row["any"] for row in unseen.select(vector_to_array("probability").alias("p")).select(any_family).collect()]
    certain = max([CERTAIN, *sorted(sure)[: math.ceil(QUIET * len(sure))][-1:]])
    model = regression.fit(featured)
    examples.unpersist()
    matrix = model.coefficientMatrix.toArray()
    weights = [(gram, [round(float(x), 4) for x in matrix[:, j]]) for j, gram in enumerate(vectors.vocabulary)]
    return Model(families, [round(float(x), 4) for x in model.interceptVector], weights, certain)


def _constant(value: object, schema: str) -> str:
    """A constant of a nested type, as an expression that is evaluated once."""
    text = json.dumps(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"from_json('{text}', '{schema}')"


def _paragraphs(docs: DataFrame, keep: Sequence[str], templates: str) -> DataFrame:
    """``keep``, ``paragraph``, ``begin`` and ``notice`` of the paragraphs that hold a licence word."""
    # Lambdas see one lowered text each, and what they are given as an element is evaluated once.
    any_stem = " OR ".join(f"contains(t, '{stem}')" for stem in _STEMS)
    capitals = " OR ".join(f"contains(text, '{word}')" for word in _CAPITALS)
    words = r"regexp_extract_all(lower(l), r'[\p{L}\p{N}]+(?:[.-][\p{L}\p{N}]+)*', 0)"
    pairs = "transform(sequence(1, greatest(size(w) - 1, 1)), i -> array_join(slice(w, i, 2), ' '))"
    whole = f"exists(transform(transform(array({words}), w -> {pairs}), p -> exists({templates}, t -> array_contains(p, t.p[0]) AND size(array_except(t.p, p)) = 0)), x -> x)"
    # 0: no words, 1: may go on, 2: stands alone, 3: may be begun, but ends a sentence.
    mark = rf"""CASE WHEN NOT l RLIKE r'[\p{{L}}\p{{N}}]' THEN 0 WHEN l RLIKE r"{_ANY_WORD}" AND {whole} THEN 2
                WHEN l RLIKE r"{_STOP}" THEN 3 ELSE 1 END"""
    firsts = "filter(sequence(0, size(lines) - 1), i -> i = 0 OR marks[i] IN (0, 2) OR marks[i - 1] <> 1)"
    runs = """transform(firsts, (i, k) -> struct(i AS first, array_join(slice(lines, i + 1, coalesce(get(firsts, k + 1), size(lines)) - i), '\n') AS notice))"""
    begins = "transform(found, r -> struct(r.first, length(array_join(slice(lines, 1, r.first), ' ')) + int(r.first > 0) AS begin, r.notice))"
    return (
        docs.where(F.expr(f"exists(array(lower(text)), t -> {any_stem}) OR {capitals}"))
        .where(F.col("text").rlike(_ANY_WORD))
        .select(*keep, F.split("text", "\n").alias("lines"))
        .select(*keep, "lines", F.expr(f"transform(lines, l -> {mark})").alias("marks"))
        .select(*keep, "lines", F.expr(firsts).alias("firsts"))
        .select(*keep, "lines", F.filter(F.expr(runs), lambda r: r["notice"].rlike(_ANY_WORD)).alias("found"))
        .select(*keep, F.explode(F.expr(begins)).alias("one"))
        .select(*keep, F.col("one.first").alias("paragraph"), "one.begin", "one.notice")
    )


def licence_paragraphs(docs: DataFrame, model: Model | None = None, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Every paragraph of the whole texts that holds a licence word, and what it is.

    Returns ``keep``, ``paragraph`` (number of its first line, from 0), ``begin``
    (its first character, from 0; it ends ``length(notice)`` later), ``licence`` (a family, or ``unknown``),
    ``probability`` (of that class, by the classifier), ``template_share`` (word pairs of the
    family's nearest template found), ``confirmed``, ``also`` (further families that are possible and have a
    whole notice there, by name) and ``notice`` (the text).
    NULL and empty texts have no paragraph. Repeated rows give repeated rows.
    The columns of ``docs`` outside ``keep`` and ``text`` are ignored.
    """
    spark = docs.sparkSession
    model = model or train(spark)
    number = len(model.families)
    weights = _constant([{"g": g, "w": w} for g, w in model.weights], "array<struct<g:string,w:array<double>>>")
    vocabulary = _constant([g for g, _ in model.weights], "array<string>")
    intercepts = f"array({', '.join(f'{x!r}D' for x in model.intercepts)})"
    known = _rows(spark, NOTICES).withColumn("words", _words(F.col("text"))).select("family", _pairs("words").alias("pairs")).collect()
    templates = _constant([{"f": r["family"], "p": r["pairs"]} for r in known], "array<struct<f:string,p:array<string>>>")
    lines = _paragraphs(docs, keep, templates).withColumn("words", _words(F.col("notice"))).withColumn("tokens", _tokens(F.col("notice")))
    # A lambda's argument is evaluated once, an expression that several others use each time.
    sums = F.expr(
        f"""transform(array(array_intersect(ngrams, {vocabulary})), hits -> aggregate(
            filter({weights}, e -> array_contains(hits, e.g)), {intercepts}, (a, e) -> zip_with(a, e.w, (x, y) -> x + y)))[0]"""
    )
    softmax = F.expr(
        """transform(transform(array(logits), l -> transform(l, x -> exp(x - array_max(l)))),
            o -> transform(o, x -> x / aggregate(o, 0D, (a, y) -> a + y)))[0]"""
    )
    scored = (
        lines.withColumn("ngrams", _features("tokens"))
        .withColumn("pairs", _pairs("words"))
        .withColumn("logits", sums)
        .withColumn("odds", softmax)
        .withColumn("best", F.expr(f"array_max(transform(slice(odds, 2, {number - 1}), (x, i) -> struct(x, i)))"))
    )
    names = F.array(*map(F.lit, model.families))
    certain = 1 - F.get("odds", F.lit(0)) >= model.certain
    share = F.expr(
        f"coalesce(array_max(transform(filter({templates}, t -> t.f = licence), t -> size(array_intersect(pairs, t.p)) / size(t.p))), 0D)"
    )
    families = f"array({', '.join(repr(f) for f in model.families)})"
    also = F.expr(
        f"""array_sort(array_distinct(transform(filter({templates}, t -> licence <> '{UNKNOWN}' AND t.f <> licence
            AND odds[array_position({families}, t.f) - 1] >= {POSSIBLE} * best.x AND size(array_except(t.p, concat(pairs, words))) = 0), t -> t.f)))"""
    )
    return (
        scored.withColumn("licence", F.when(certain, F.get(names, F.col("best.i") + 1)).otherwise(F.lit(UNKNOWN)))
        .withColumn("template_share", share)
        .select(
            *keep,
            "paragraph",
            "begin",
            "licence",
            F.get("odds", F.array_position(names, F.col("licence")).cast("int") - 1).alias("probability"),
            "template_share",
            (F.col("template_share") >= CONFIRMED).alias("confirmed"),
            also.alias("also"),
            "notice",
        )
    )
