"""License scans: a trained paragraph classifier confirmed against templates.

Features are the word n-grams (one and two words) that occur in any licence
template, as a sparse set per paragraph. A multinomial logistic regression over
them, fitted by Spark's own ML library, tells the licence families and an unknown
class. It learns from the templates, from variants of them (words left out, in
longer prose), and from a bounded sample of ordinary paragraphs of the corpus
(``MAX_ORDINARY``). The confidence that parts licences from the unknown class is
set on variants kept aside. A prediction counts as confirmed when the paragraph
holds enough of the words of one of the family's templates.

A paragraph ends at a line without letters or digits. So that a wrapped notice is
judged as a whole and a notice among other lines is not drowned by them, every
line, the first ``WINDOWS`` words from each line on and the joined paragraph are
judged; the paragraph has every family confirmed in one of them.

Scoring is one projection over the scan: no user functions and no shuffle. A
paragraph without any cue word of the templates has no feature that could lift a
family above unknown and is not scored.

Defined results: NULL and empty texts have no paragraph; columns of the input
that clash with added ones are replaced.
"""

from __future__ import annotations

import json
import random
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import BLANK, let

UNKNOWN = "unknown"
MAX_ORDINARY = 400
VARIANTS = 30  # per template
CONFIRMED = 0.6  # of a template's words

# Short public notices by which the families are recognised.
TEMPLATES = {
    "mit": (
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files, to deal in the Software without restriction.",
    ),
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "Licensed under the GNU Lesser General Public License, version 2.1.",
    ),
    "cc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
    ),
    "bsd": (
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met.",
    ),
    "proprietary": (
        "Copyright 2020 Example Corporation. All rights reserved.",
        "All rights reserved. No part of this work may be reproduced without written permission.",
    ),
}

# Stems of which at least one is in every template; words may be apart by a line's end and its comment mark.
CUES = (
    "licen", "copyright", "spdx", r"rights[^\p{L}\p{N}]+reserved", r"creative[^\p{L}\p{N}]+commons",
    "redistribut", "permission", "gnu",
)
CUE = "(?i)" + "|".join(CUES)
WINDOWS = (20, 40)  # words; the longest template has 29


def paragraphs(text: Column) -> Column:
    """The paragraphs of ``text`` that hold a cue word, each as the array of its lines.

    Lines without a letter or digit part paragraphs; comment marks before a line's
    first letter or digit are left out.
    """
    lines = F.regexp_replace(text, r"\r\n?", "\n")
    blocks = F.filter(F.split(lines, r"\n[^\p{L}\p{N}\n]*(?=\n)"), lambda b: F.rlike(b, F.lit(CUE)))

    def bare(line: Column) -> Column:
        return F.regexp_replace(line, r"^[^\p{L}\p{N}]*(?:(?i:dnl|rem)\s+)?", "")

    cut = F.transform(blocks, lambda b: F.filter(F.transform(F.split(b, "\n"), bare), lambda x: x != ""))
    return F.when(F.rlike(text, F.lit(CUE)), cut).otherwise(F.array().cast("array<array<string>>"))


def units(lines: Column) -> Column:
    """What is judged of a paragraph: its lines, the words from each line on, and the whole."""

    def windows(line: Column, i: Column) -> Column:
        # a line has a word at least
        tail = F.split(F.array_join(F.slice(lines, i + 1, max(WINDOWS)), " "), f"{BLANK}+")
        cut = lambda t: F.array(*[F.array_join(F.slice(t, 1, n), " ") for n in WINDOWS])
        return F.concat(F.array(line), F.element_at(F.transform(F.array(tail), cut), 1))

    whole = F.array(F.array_join(lines, " "))
    every = F.when(F.size(lines) == 1, whole).otherwise(
        F.concat(F.flatten(F.transform(lines, windows)), whole)
    )
    return F.filter(F.array_distinct(every), lambda u: F.rlike(u, F.lit(CUE)))


def tokens(line: Column) -> Column:
    plain = F.regexp_replace(F.lower(line), r"[^\p{L}\p{N}.\-\x20\x09-\x0D]+", " ")
    plain = F.regexp_replace(plain, r"[.](?=\s|$)", " ")
    return F.array_remove(F.split(plain, f"{BLANK}+"), "")


def ngrams(words: Column) -> Column:
    """The distinct one- and two-word grams."""
    follow = F.slice(words, 2, F.size(words))
    pairs = F.filter(
        F.zip_with(words, follow, lambda a, b: F.when(b.isNotNull(), F.concat_ws(" ", a, b))),
        lambda g: g.isNotNull(),
    )
    return F.array_distinct(F.concat(words, pairs))


@dataclass
class Scanner:
    """A fitted classifier: ``weights[class][gram]``, one intercept per class."""

    classes: list[str]
    vocabulary: list[str]
    weights: list[list[float]]
    intercepts: list[float]
    threshold: float

    def verdict(self, line: Column) -> Column:
        """struct(family, confidence, confirmed) of one paragraph."""
        index = F.from_json(
            F.lit(json.dumps({g: i for i, g in enumerate(self.vocabulary)})), "map<string,int>"
        )
        table = [F.from_json(F.lit(json.dumps(w)), "array<double>") for w in self.weights]
        words = tokens(line)
        places = F.filter(
            F.transform(ngrams(words), lambda g: F.try_element_at(index, g)), lambda i: i.isNotNull()
        )
        scores = F.transform(
            F.array(places),
            lambda p: F.array(
                *[
                    F.aggregate(p, F.lit(float(b)), _adding(t))
                    for t, b in zip(table, self.intercepts)
                ]
            ),
        )
        names = F.array(*[F.lit(c) for c in self.classes])
        # exp of score minus the greatest score
        shares = F.transform(
            scores,
            lambda s: F.transform(s, lambda x: F.exp(x - F.array_max(s))),
        )
        best = F.transform(
            shares,
            lambda e: F.struct(
                F.element_at(names, F.array_position(e, F.array_max(e)).cast("int")).alias("family"),
                (F.array_max(e) / F.aggregate(e, F.lit(0.0), lambda a, x: a + x)).alias("confidence"),
            ),
        )

        def judge(b: Column) -> Column:
            known = (b["family"] != UNKNOWN) & (b["confidence"] >= self.threshold)
            return F.struct(
                F.when(known, b["family"]).otherwise(UNKNOWN).alias("family"),
                b["confidence"].alias("confidence"),
                (known & _confirms(b["family"], words)).alias("confirmed"),
            )

        return F.element_at(F.transform(best, judge), 1)


def _adding(weights: Column):
    return lambda total, i: total + F.get(weights, i)


def _words_of(template: str) -> list[str]:
    import re

    plain = re.sub(r"[^\w.\-\s]+", " ", template.lower())
    return [w for w in re.sub(r"[.](?=\s|$)", " ", plain).split() if w]


def _confirms(family: Column, words: Column) -> Column:
    """Whether ``words`` hold enough of one template of ``family``."""
    out = F.lit(False)
    for name, templates in TEMPLATES.items():
        hit = F.lit(False)
        for t in templates:
            wanted = sorted(set(_words_of(t)))
            held = F.size(F.array_intersect(words, F.array(*[F.lit(w) for w in wanted])))
            hit = hit | (held >= CONFIRMED * len(wanted))
        out = F.when(family == name, hit).otherwise(out)
    return out


def _variants() -> list[tuple[str, str]]:
    """(paragraph, class): templates with words left out or set in other words, and decoys."""
    draw = random.Random(5)
    filler = "the of and to in is for that this on with as by at from an be or it are".split()
    out = []
    for family, templates in TEMPLATES.items():
        for t in templates:
            words = t.split()
            for k in range(VARIANTS):
                some = [w for w in words if draw.random() > 0.02 * (k % 8)] or words
                around = [draw.choice(filler) for _ in range(k % 5)]
                out.append((" ".join(around + some), family))
    # decoys: the same vocabulary without a notice
    pool = sorted({w for ts in TEMPLATES.values() for t in ts for w in _words_of(t)})
    plain = [w for w in pool if len(w) < 5] + filler
    for k in range(len(out) // 2):
        some = [draw.choice(plain) for _ in range(5 + k % 30)] + draw.sample(pool, 1 + k % 2)
        draw.shuffle(some)
        out.append((" ".join(some), UNKNOWN))
    return out


def train(spark: SparkSession, docs: DataFrame | None = None, text_col: str = "text") -> Scanner:
    """Fit on templates, variants and at most ``MAX_ORDINARY`` ordinary paragraphs of ``docs``."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    rows = _variants()
    if docs is not None:
        cue = F.lit(CUE)
        lines = docs.select(F.explode(F.split(F.col(text_col), "\n")).alias("line"))
        ordinary = lines.filter(~F.rlike("line", cue) & (F.length("line") > 0)).limit(MAX_ORDINARY)
        rows += [(r.line[:4000], UNKNOWN) for r in ordinary.collect()]
    classes = [*TEMPLATES, UNKNOWN]
    given = spark.createDataFrame(
        [(i, t, float(classes.index(c))) for i, (t, c) in enumerate(rows)], "i int, line string, label double"
    ).withColumn("grams", ngrams(tokens(F.col("line"))))
    # grams of the templates themselves: a bounded vocabulary
    own = [t for ts in TEMPLATES.values() for t in ts]
    grams = spark.createDataFrame([(t,) for t in own], "line string").select(
        F.explode(ngrams(tokens(F.col("line")))).alias("g")
    )
    vocabulary = sorted(r.g for r in grams.distinct().collect())
    names = F.from_json(F.lit(json.dumps(vocabulary)), "array<string>")
    dense = F.transform(names, lambda g: F.array_contains("grams", g).cast("double"))
    vectors = given.select("i", "label", array_to_vector(dense).alias("features"))
    aside = F.col("i") % 5 == 4
    fitted = LogisticRegression(maxIter=60, regParam=1e-3, family="multinomial").fit(vectors.filter(~aside))
    weights = [[round(float(x), 6) for x in row] for row in fitted.coefficientMatrix.toArray()]
    scanner = Scanner(
        classes, vocabulary, weights, [float(x) for x in fitted.interceptVector.toArray()], 0.0
    )
    kept = given.filter(aside).select("label", scanner.verdict(F.col("line")).alias("v")).collect()
    right = [r.v.confidence for r in kept if r.v.family == classes[int(r.label)] != UNKNOWN]
    wrong = [
        r.v.confidence for r in kept if r.v.family != UNKNOWN and r.v.family != classes[int(r.label)]
    ]
    # between the surest mistake and the least sure hit, nearer to the mistakes' side
    low, high = max(wrong, default=0.0), sorted(right)[len(right) // 50] if right else 1.0
    scanner.threshold = max(0.5, min(high, low + 0.01 if low < high else high))
    return scanner


def _together(verdicts: Column) -> Column:
    """One struct of the verdicts of a paragraph's units, ``families`` the confirmed ones."""
    best = F.array_max(
        F.transform(
            verdicts,
            lambda v: F.struct(
                v["confirmed"].alias("confirmed"),
                (v["family"] != UNKNOWN).alias("known"),
                v["confidence"].alias("confidence"),
                v["family"].alias("family"),
            ),
        )
    )
    sure = F.transform(F.filter(verdicts, lambda v: v["confirmed"]), lambda v: v["family"])
    return let(
        best,
        lambda b: F.struct(
            b["family"].alias("family"),
            b["confidence"].alias("confidence"),
            b["confirmed"].alias("confirmed"),
            F.sort_array(F.array_distinct(sure)).alias("families"),
        ),
    )


def scan(docs: DataFrame, scanner: Scanner, text_col: str = "text") -> DataFrame:
    """``docs`` with ``verdicts`` (one struct per cue paragraph), ``families``, ``family``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    step = docs.withColumn("_lines", paragraphs(text))

    def judged(lines: Column) -> Column:
        return let(F.transform(units(lines), scanner.verdict), _together)

    step = step.withColumn("verdicts", F.transform("_lines", judged)).drop("_lines")
    sure = F.filter("verdicts", lambda v: v["confirmed"])
    top = F.sort_array(
        F.transform(sure, lambda v: F.struct(v["confidence"].alias("c"), v["family"].alias("f"))), False
    )
    return step.withColumns(
        {
            "families": F.sort_array(F.array_distinct(F.flatten(F.transform(sure, lambda v: v["families"])))),
            "family": F.coalesce(F.get(top, F.lit(0))["f"], F.lit(UNKNOWN)),
        }
    )
