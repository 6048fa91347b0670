"""Licence scan: a trained paragraph classifier, confirmed against templates.

A paragraph is a line of a text. Its features are word 2- and 3-grams that the licence
notices below have. A multinomial logistic regression, trained on the notices, on parts
of them and on paragraphs of other content, gives each licence family and "unknown" a
probability. The level of "unknown" is calibrated on a third of the paragraphs; those of
other content among them are not trained on.
A family is confirmed if enough of the paragraph's n-grams are in its notices.

All work on the documents is in built-in column functions: paragraphs without any n-gram
of the notices are "unknown" by definition and leave at once; for the others the n-grams
are joined with the table of weights, whose size is that of the notices.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UNKNOWN = "unknown"
SPLIT = re.compile("[a-z0-9]+")

#: Usual notices of public licences, by family.
NOTICES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "MIT": (
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "SPDX-License-Identifier: MIT",
    ),
    "BSD": (
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Licensed under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "LGPL": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License.",
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ),
    "MPL": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "CC-BY": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "Text is available under CC BY 4.0.",
    ),
    "CC-BY-SA": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
    ),
    "CC-BY-NC": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
        "Free for noncommercial use under CC BY-NC 4.0.",
    ),
    "CC0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "Released into the public domain under CC0 1.0 Universal.",
        "SPDX-License-Identifier: CC0-1.0",
    ),
}
#: Sentences that share words with the notices but name no family.
OTHERS = (
    "Licensed under the terms of the agreement between the parties.",
    "This program is distributed by the publisher.",
    "All rights reserved.",
    "This work is licensed to the customer for internal use only.",
    "You may not use this file without the written permission of the owner.",
    "A copy of the agreement can be found in the office.",
    "The general public is invited to the meeting.",
    "Use of this site is governed by the terms of service.",
    "Released under embargo by the press office.",
    "This source is subject to change without notice.",
    "The above notice shall be included in all letters.",
)
#: Words too common to make a 2-gram of their own.
COMMON = frozenset("a all an and any are as at be by for from in is it no not of on or that the this to with you".split())


def words_of(text: str) -> list[str]:
    return SPLIT.findall(text.lower())


def ngrams_of(words: list[str]) -> list[str]:
    """2- and 3-grams, without those of common words only."""
    found = [words[i : i + n] for n in (2, 3) for i in range(len(words) - n + 1)]
    return list(dict.fromkeys(" ".join(g) for g in found if not COMMON.issuperset(g)))


@dataclass(frozen=True)
class Model:
    """Weights per n-gram and class, offsets per class, and the families of each n-gram."""

    classes: tuple[str, ...]
    vocabulary: dict[str, int]
    weights: np.ndarray
    bias: np.ndarray


def _parts(text: str) -> list[str]:
    """The notice and windows of its words, as copies with changed ends have them."""
    words = words_of(text)
    n = len(words)
    spans = {(0, n)} | {(i, j) for size in (max(4, n // 2), max(4, 3 * n // 4)) for i in range(0, n - size + 1) for j in [i + size]}
    return [" ".join(words[i:j]) for i, j in sorted(spans)]


def other_paragraphs(docs: DataFrame, rows: int = 1000) -> list[str]:
    """One paragraph of about ``rows`` documents, chosen by hash, that names no licence."""
    every = max(1, docs.count() // rows)
    lines = F.split("text", "\n", -1)
    some = docs.where(F.col("text").isNotNull() & (F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(every)) == 0)).select(
        F.element_at(lines, (F.pmod(F.xxhash64("doc_id", F.lit(2)), F.size(lines)) + 1).cast("int")).alias("p")
    )
    named = F.col("p").rlike("(?i)licen[cs]e|copyright|spdx")
    # A paragraph of any length is a row of the sample; 2000 characters of it are enough to fit.
    return [r[0] for r in some.where(~named).select(F.substring("p", 1, 2000)).limit(2 * rows).collect()]


def fit(spark: SparkSession, others: list[str]) -> Model:
    """Train on the notices and their parts, calibrate "unknown" on every third paragraph.

    Parts of notices are few, so those of the third are trained on too; others are not.
    """
    classes = (*NOTICES, UNKNOWN)
    texts = [(k, p) for k, f in enumerate(NOTICES.values()) for t in f for p in _parts(t)]
    texts += [(len(NOTICES), p) for t in OTHERS for p in _parts(t)] + [(len(NOTICES), p) for p in others]
    vocabulary = {g: i for i, g in enumerate(sorted({g for f in NOTICES.values() for t in f for g in ngrams_of(words_of(t))}))}
    rows = [(k, sorted({vocabulary[g] for g in ngrams_of(words_of(p)) if g in vocabulary})) for k, p in texts]
    rows = [(k, at) for k, at in rows if at]
    spread = [(k, at, n % 3 != 0) for n, (k, at) in enumerate(rows)]
    train = [(k, at) for k, at, used in spread if used or k < len(NOTICES)]
    held = [(k, at) for k, at, used in spread if not used]
    weight, bias = _regression(spark, train, len(vocabulary), len(classes))
    return Model(classes, vocabulary, weight, _calibrated(held, weight, bias, len(classes)))


def _regression(spark: SparkSession, train: list[tuple], width: int, n_classes: int) -> tuple[np.ndarray, np.ndarray]:
    data = spark.createDataFrame(
        [(float(k), Vectors.sparse(width, [(i, 1.0) for i in at])) for k, at in train], ["label", "features"]
    ).coalesce(1)
    model = LogisticRegression(family="multinomial", maxIter=60, regParam=2e-3, standardization=False).fit(data)
    weight, bias = np.zeros((n_classes, width)), np.full(n_classes, -20.0)
    found = model.coefficientMatrix.toArray()
    weight[: len(found)] = found
    bias[: len(found)] = model.interceptVector.toArray()
    return weight, bias


def _calibrated(held: list[tuple], weight: np.ndarray, bias: np.ndarray, n_classes: int) -> np.ndarray:
    """Shift the unknown class until its mean probability is its share of the held rows."""
    unknown = n_classes - 1
    share = sum(k == unknown for k, _ in held) / max(1, len(held))
    score = np.array([weight[:, at].sum(1) + bias for _, at in held]).reshape(len(held), n_classes)
    low, high = -10.0, 10.0
    for _ in range(50):
        shift = (low + high) / 2
        moved = score + shift * (np.arange(n_classes) == unknown)
        p = np.exp(moved - moved.max(1, keepdims=True))
        mean = (p[:, unknown] / p.sum(1)).mean() if len(held) else share
        low, high = (shift, high) if mean < share else (low, shift)
    return bias + (low + high) / 2 * (np.arange(n_classes) == unknown)


def _grams(words: Column, n: int) -> Column:
    """The n-grams of an array of words."""
    last = F.size(words) - (n - 1)
    at = lambda i, k: F.get(words, (i + k).cast("int"))
    made = lambda i: F.concat_ws(" ", *(at(i, k) for k in range(n)))
    return F.when(last > 0, F.transform(F.sequence(F.lit(0), last - 1), made)).otherwise(F.array().cast("array<string>"))


def scanned(docs: DataFrame, model: Model, doubt: float = 0.99, confirm: float = 0.6) -> DataFrame:
    """Paragraphs that look like licence notices: one row each.

    ``doc_id, paragraph, family, probability, p_unknown, template_share, confirmed``:
    ``paragraph`` is the line number from 0; ``family`` may be "unknown". Rows with
    ``p_unknown`` from ``doubt`` on are ordinary text and left out. ``template_share`` is the
    share of the paragraph's n-grams that the family's notices have; from ``confirm`` on the
    family is confirmed. Null and empty texts have no paragraphs with words. Repeated rows
    give repeated results.
    """
    spark, classes = docs.sparkSession, model.classes
    pairs = [g for g in model.vocabulary if g.count(" ") == 1]
    listed = docs.where(F.col("text").isNotNull()).select(
        "doc_id", F.posexplode(F.split("text", "\n", -1)).alias("paragraph", "p")
    )
    # The words are bound as a lambda's variable: else each n-gram would cut the text again.
    words = F.array(F.regexp_extract_all(F.lower("p"), F.lit("[a-z0-9]+"), F.lit(0)))
    # A paragraph with one of the 2-grams has that one's longest word, which is cheap to see.
    marks = sorted({max((w for w in g.split() if w not in COMMON), key=len) for g in pairs})
    marked = F.arrays_overlap(words[0], F.array(*map(F.lit, marks)))
    near = listed.where(marked & F.exists(words, lambda w: F.exists(_grams(w, 2), lambda g: g.isin(pairs))))
    grams = F.transform(words, lambda w: F.array_distinct(F.concat(_grams(w, 2), _grams(w, 3))))[0]
    numbered = near.select("doc_id", "paragraph", F.monotonically_increasing_id().alias("row"), grams.alias("g"))
    # As many rows as the notices have n-grams, whatever the documents.
    members = {f: {g for t in NOTICES[f] for g in ngrams_of(words_of(t))} for f in classes[:-1]}
    rows = [
        {"gram": g, "w": model.weights[:, i].tolist(), "m": [int(g in members[f]) for f in classes[:-1]]}
        for g, i in model.vocabulary.items()
    ]
    # One literal: as many columns and rows of literals take the planner a minute.
    kind = "array<struct<gram string, w array<double>, m array<int>>>"
    table = spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), kind)))
    joined = numbered.select("doc_id", "paragraph", "row", F.size("g").alias("n"), F.explode("g").alias("gram")).join(
        F.broadcast(table), "gram"
    )
    sums = joined.groupBy("row", "doc_id", "paragraph", "n").agg(
        *(F.sum(F.col("w")[k]).alias(f"w{k}") for k in range(len(classes))),
        *(F.sum(F.col("m")[k]).alias(f"m{k}") for k in range(len(classes) - 1)),
    )
    scores = F.array(*(F.col(f"w{k}") + F.lit(float(model.bias[k])) for k in range(len(classes))))
    best = F.array_max("s")
    total = F.aggregate(F.transform("s", lambda x: F.exp(x - F.col("best"))), F.lit(0.0), lambda a, x: a + x)
    at = (F.array_position("s", F.col("best")) - 1).cast("int")
    found = (
        sums.withColumn("s", scores)
        .withColumn("best", best)
        .withColumn("total", total)
        .withColumn("at", at)
        .withColumn("p_unknown", F.exp(F.element_at("s", -1) - F.col("best")) / F.col("total"))
    )
    shares = F.array(*(F.col(f"m{k}") / F.col("n") for k in range(len(classes) - 1)), F.lit(0.0))
    return found.where(F.col("p_unknown") < doubt).select(
        "doc_id",
        "paragraph",
        F.get(F.array(*map(F.lit, classes)), F.col("at")).alias("family"),
        (1 / F.col("total")).alias("probability"),
        "p_unknown",
        F.get(shares, F.col("at")).alias("template_share"),
        (F.get(shares, F.col("at")) >= confirm).alias("confirmed"),
    )
