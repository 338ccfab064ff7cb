"""Licence statements in documents, in DataFrame functions only.

A multinomial logistic regression over sparse word 1- and 2-grams gives every
paragraph (line) a licence family, ``unknown`` (a licence statement of no known
family) or none.  The cutoff below which a family becomes ``unknown`` is
calibrated by leaving each family out of the training in turn.  A family is
confirmed by comparing the paragraph's word pairs with the family's templates.

Only n-grams that hold an anchor word are features, so a paragraph without any
anchor has no feature and is none: the anchors select candidate paragraphs
without losing any.  Training looks at the fixed table below, on the driver.
"""

from __future__ import annotations

import re
from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, text_or_empty

NONE, UNKNOWN = "none", "unknown"

#: Statements by which works name their licence, by family.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "This project is licensed under the Apache License 2.0", "Released under the Apache 2.0 license.", "SPDX-License-Identifier: Apache-2.0",
        "Apache License Version 2.0, January 2004"],
    "BSD": [
        "Released under the BSD License.", "Licensed under the BSD 3-Clause License.", "This software is distributed under the BSD 2-clause license.",
        "SPDX-License-Identifier: BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "CC": [
        "Licensed under CC BY-NC 4.0.", "Licensed under CC BY 4.0.", "Licensed under CC BY-SA 3.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "This work is licensed under the Creative Commons Attribution-NonCommercial-ShareAlike license.", "Text is available under the Creative Commons Attribution-ShareAlike License",
        "Released under CC0.", "SPDX-License-Identifier: CC-BY-4.0", "Content is licensed under CC BY-NC-ND 4.0"],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "Licensed under the GPL version 2 or later.", "Released under the GNU GPL v3.", "SPDX-License-Identifier: GPL-3.0-or-later", "This software is distributed under the GPL license.",
        "You should have received a copy of the GNU General Public License along with this program."],
    "LGPL": [
        "Licensed under the GNU Lesser General Public License, version 2.1.", "This library is free software under the terms of the GNU Lesser General Public License", "Released under the LGPL.",
        "SPDX-License-Identifier: LGPL-2.1-only", "Licensed under the LGPL version 3"],
    "MIT": [
        "Released under the MIT License.", "Licensed under the MIT license.", "This project is licensed under the terms of the MIT license.", "SPDX-License-Identifier: MIT", "The MIT License (MIT)",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"],
    "MPL": [
        "Licensed under the Mozilla Public License, version 2.0.", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Released under the MPL 2.0.",
        "SPDX-License-Identifier: MPL-2.0"],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.", "Released under the Unlicense.", "SPDX-License-Identifier: Unlicense", "Dedicated to the public domain under the Unlicense."],
}
#: Licence statements of no listed family, and sentences that only use the words.
UNKNOWN_STATEMENTS = [
    "Licensed under the terms found in the LICENSE file.", "Released under the Example Software License, version 1.", "This work is licensed under its own license.",
    "See the license agreement for the terms of use.", "Licensed under the Community Source License 1.0", "Released under a proprietary license.", "Distributed under the Widget Public License",
    "SPDX-License-Identifier: LicenseRef-Own", "This product is licensed, not sold, under the vendor license."]
OTHER = [
    "The driver lost a license after the accident.", "The shop is licensed to sell beer.", "An apache helicopter flew over the town.", "The creative team met in the commons.", "Copyright is a law about works.",
    "A gnu is an animal of the plains.", "The permission was granted by the city.", "Public transport is free for any person.", "The fishing license costs ten coins.", "Mozilla made a browser.",
    "Poetic license lets writers bend the rules.", "They met on the commons in spring.", "Redistribution of income is a matter of politics.", "Her creative work was shown in public.",
    "The general public is invited.", "The software runs in the browser.", "His licence to fly ended in May.", "A license plate was found near the road."]
ANCHORS = sorted(set("license licence licensed licenced licenses licences licensing unlicense apache gnu gpl lgpl agpl bsd cc cc0 creative commons mozilla mpl "
                     "spdx redistribution unencumbered permission granted".split()))
#: Template likeness from which a family is confirmed.
CONFIRMED = 0.5


def words_of(paragraph: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", paragraph.lower())


def grams_of(paragraph: str) -> set[str]:
    """1- and 2-grams that hold an anchor."""
    w = words_of(paragraph)
    return {g for g in w + [f"{a} {b}" for a, b in zip(w, w[1:])] if not set(g.split()).isdisjoint(ANCHORS)}


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(examples: list[tuple[str, str]], rounds: int = 400, ridge: float = 2e-3) -> tuple[list[str], dict[str, np.ndarray], np.ndarray]:
    """Classes, weights by n-gram, and biases, by gradient descent."""
    classes = sorted({c for _, c in examples})
    grams = sorted({g for p, _ in examples for g in grams_of(p)})
    column = {g: k for k, g in enumerate(grams)}
    x = np.zeros((len(examples), len(grams)))
    for i, (p, _) in enumerate(examples):
        x[i, [column[g] for g in grams_of(p)]] = 1.0
    y = np.array([[c == k for k in classes] for _, c in examples], dtype=float)
    weight = (1 / y.sum(axis=0))[y.argmax(axis=1)][:, None] / len(classes)
    w, b = np.zeros((len(grams), len(classes))), np.zeros(len(classes))
    for _ in range(rounds):
        error = weight * (_softmax(x @ w + b) - y)
        w -= 8.0 * (x.T @ error + ridge * w)
        b -= 8.0 * error.sum(axis=0)
    return classes, {g: w[k] for g, k in column.items()}, b


def _examples(without: str = "") -> list[tuple[str, str]]:
    known = [(p, f) for f, ps in TEMPLATES.items() if f != without for p in ps]
    return known + [(p, UNKNOWN) for p in UNKNOWN_STATEMENTS] + [(p, NONE) for p in OTHER] + [("", NONE)] * 4


def _score(model, paragraph: str) -> np.ndarray:
    classes, weights, bias = model
    return _softmax((bias + sum((weights[g] for g in grams_of(paragraph) if g in weights), np.zeros(len(classes))))[None, :])[0]


@cache
def model() -> tuple[list[str], dict[str, np.ndarray], np.ndarray, float]:
    """The classifier and its cutoff: the probability that nine in ten
    statements of a family left out of training stay below, and at most that
    which nine in ten of the templates reach."""
    m = fit(_examples())
    strangers = []
    for family in TEMPLATES:
        part = fit(_examples(family), rounds=150)
        known = [k for k, c in enumerate(part[0]) if c not in (NONE, UNKNOWN)]
        strangers += [_score(part, p)[known].max() for p in TEMPLATES[family]]
    own = [_score(m, p)[m[0].index(f)] for f, ps in TEMPLATES.items() for p in ps]
    return (*m, float(min(np.quantile(strangers, 0.9), np.quantile(own, 0.1))))


def paragraphs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, at, words)`` of the paragraphs that hold an anchor."""
    line = docs.select(F.col(id_col).alias("id"), F.posexplode(F.split(text_or_empty(text_col), "\n")).alias("at", "line"))
    line = line.where(F.col("line").rlike(r"(?i)(?<![a-z0-9])(?:" + "|".join(ANCHORS) + r")(?![a-z0-9])"))
    return line.select("id", "at", F.filter(F.split(F.lower("line"), "[^a-z0-9]+"), lambda w: w != "").alias("words"))


def grams(words: Column) -> Column:
    pairs = F.when(F.size(words) < 2, F.array().cast("array<string>")).otherwise(
        F.zip_with(F.slice(words, F.lit(1), F.size(words) - 1), F.slice(words, F.lit(2), F.size(words) - 1), lambda a, b: F.concat_ws(" ", a, b)))
    return pairs


def scan_paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, at, family, probability, likeness, confirmed)`` of every licence
    statement; ``at`` is the line's number from 0."""
    spark = docs.sparkSession
    classes, weights, bias, cutoff = model()
    par = paragraphs(docs, id_col, text_col).withColumn("pairs", grams(F.col("words")))
    gram = F.explode(F.array_distinct(F.concat("words", "pairs")))
    table = spark.createDataFrame([(g, [float(x) for x in w]) for g, w in sorted(weights.items())], "gram string, w array<double>")
    scored = par.select("id", "at", gram.alias("gram")).join(F.broadcast(table), "gram").groupBy("id", "at").agg(
        *[F.sum(F.col("w")[k]).alias(f"z{k}") for k in range(len(classes))])
    z = [F.col(f"z{k}") + F.lit(float(bias[k])) for k in range(len(classes))]
    top = F.greatest(*z)
    total = sum((F.exp(x - top) for x in z[1:]), F.exp(z[0] - top))
    of = dict(zip(classes, z, strict=True))
    some = F.greatest(*[x for c, x in of.items() if c != NONE])
    best = F.coalesce(*[F.when(x == some, F.lit(c)) for c, x in of.items() if c != NONE])
    # a statement of some kind is likelier than none; which kind is the best of the others
    found = scored.select("id", "at", best.alias("best"), (F.exp(some - top) / total).alias("probability"), (F.exp(of[NONE] - top) / total).alias("none"))
    found = cut(found.where(F.col("none") < 0.5).drop("none"), "licences")
    # template comparison: shared word pairs over the smaller set, per template
    pairs = [(f, n, sorted({f"{a} {b}" for a, b in zip(words_of(p), words_of(p)[1:])})) for f, ps in TEMPLATES.items() for n, p in enumerate(ps)]
    sizes = spark.createDataFrame([(f, n, len(g)) for f, n, g in pairs if g], "f string, n int, size int")
    template = spark.createDataFrame([(f, n, x) for f, n, g in pairs for x in g], "f string, n int, gram string")
    own = (par.select(F.col("id").alias("i"), F.col("at").alias("t"), F.explode(F.array_distinct("pairs")).alias("gram"), F.size(F.array_distinct("pairs")).alias("own"))
           .join(F.broadcast(template), "gram").groupBy("i", "t", "f", "n", "own").count().join(F.broadcast(sizes), ["f", "n"])
           .withColumn("like", F.col("count") / F.least("own", "size")).groupBy("i", "t", "f").agg(F.max("like").alias("like")))
    joined = found.join(own, found["id"].eqNullSafe(own["i"]) & (F.col("at") == F.col("t")) & (F.col("best") == F.col("f")), "left")
    known = (F.col("best") != UNKNOWN) & (F.col("probability") >= cutoff)
    likeness = F.coalesce("like", F.lit(0.0))
    return joined.select("id", "at", F.when(known | (likeness >= 0.999), F.col("best")).otherwise(UNKNOWN).alias("family"), "probability",
                         likeness.alias("likeness"), (likeness >= CONFIRMED).alias("confirmed"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col``, ``n_statements`` (long), ``family``
    (of the most probable statement; ties: the first line; null: none),
    ``probability``, ``confirmed``, and ``families`` (distinct, sorted).

    Rows that share an id count as one document.  Null and empty texts have no
    statements, a null id is an id.  Texts are scanned whole.
    """
    s = scan_paragraphs(docs, id_col, text_col)
    # rows that share an id may repeat a line: one statement a line
    s = s.groupBy("id", "at").agg(F.max(F.struct("probability", "family", "confirmed")).alias("s")).select("id", "at", "s.*")
    per = s.groupBy("id").agg(F.count("*").alias("n"), F.max(F.struct("probability", (-F.col("at")).alias("early"), "family", "confirmed")).alias("m"),
                              F.array_join(F.array_sort(F.collect_set("family")), ",").alias("families"))
    out = docs.select(F.col(id_col).alias("_id")).join(per.hint("shuffle_hash"), F.col("_id").eqNullSafe(F.col("id")), "left")
    return out.select(F.col("_id").alias(id_col), F.coalesce("n", F.lit(0)).alias("n_statements"), F.col("m.family").alias("family"),
                      F.col("m.probability").alias("probability"), F.coalesce("m.confirmed", F.lit(False)).alias("confirmed"), F.coalesce("families", F.lit("")).alias("families"))
