"""Licence scan: a trained paragraph classifier, in DataFrame expressions only.

A logistic regression per licence family over sparse word n-grams is fitted on
template sentences set into background paragraphs, which come from a bounded
sample of the corpus.  Probabilities are calibrated on paragraphs that were held
out; a paragraph that no family reaches is of the class unknown.  A prediction is
confirmed by comparing the paragraph's word pairs with the family's templates.

Scoring runs where the texts are read.  Paragraphs without any word that a
positive weight needs can't reach a family and are passed over by one regular
expression; the others are scored by lookups in a map of weights.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BACKGROUND = 2_000  # corpus paragraphs the model is fitted on, at most
LONGEST = 2_000  # characters of a background paragraph that are used
PENALTY, STEPS, RATE = 4e-3, 600, 1.0  # L1 weight, gradient steps and step size of a fit
COMMON = 0.002  # share of the background paragraphs that an n-gram with a weight may be in
LEAST = 0.5  # calibrated probability that a family needs
SIMILAR = 0.6  # share of a template's word pairs that confirms a prediction

# Sentences of public licences and of usual licence notices.
TEMPLATES = {
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "This project is released under the Apache 2.0 license.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "bsd": [
        "Licensed under the BSD 3-Clause License.",
        "Released under the BSD license.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Available under the Creative Commons Attribution license.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Shared under CC BY-NC, for non-commercial use only.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "Released under the GPL version 2 or later.",
        "Licensed under the GNU GPL v3.",
    ],
    "lgpl": [
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it under the terms of the GNU Lesser General Public License",
        "Released under the LGPL.",
    ],
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "mpl": [
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Released under the MPL 2.0.",
    ],
}
# Sentences about licences that name no family.
OTHERS = [
    "All rights reserved.", "Copyright 2020 by the authors.", "You need a driving licence to rent a car.", "The licence fee was paid in March.",
    "This work is licensed under the terms agreed with the publisher.", "A software license is a legal instrument.", "Version 2.0 was released under a new name.",
    "This program is free of charge for any person.", "The general public may use the library.", "Terms of use and conditions apply.",
]


REACH = max(len(re.findall("[a-zA-Z0-9]+", s)) for sentences in TEMPLATES.values() for s in sentences)  # words of the longest template


class Family(NamedTuple):
    name: str
    weights: dict[str, float]
    intercept: float


def grams(text: str) -> set[str]:
    """Words, pairs and triples of a paragraph."""
    words = re.findall("[a-z0-9]+", text.lower())
    return {" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)}


def _fit(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """L1 logistic regression by proximal gradient steps; both classes weigh the same."""
    weight = np.where(y > 0, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    w, b = np.zeros(x.shape[1]), 0.0
    for _ in range(STEPS):
        error = (1 / (1 + np.exp(-(x @ w + b))) - y) * weight
        w -= RATE * (x.T @ error)
        b -= RATE * error.sum()
        w = np.sign(w) * np.maximum(np.abs(w) - RATE * PENALTY, 0)
    return w, b


def train(background: list[str]) -> tuple[list[Family], Counter]:
    """One calibrated model per family, and how many background paragraphs have an n-gram;
    ``background`` are paragraphs of no family."""
    random = np.random.RandomState(8)
    names, texts, owner = sorted(TEMPLATES), [], []
    for k, name in enumerate(names):
        for sentence in TEMPLATES[name]:
            for n in range(12):
                around = background[random.randint(len(background))].split() if background and n else []
                cut = random.randint(len(around) + 1)
                texts.append(" ".join([*around[max(0, cut - 12) : cut], sentence, *around[cut : cut + 12]]))
                owner.append(k)
    texts += OTHERS * 6 + background
    owner += [-1] * (len(texts) - len(owner))
    # only n-grams that templates have, and the background hardly, can have a weight
    often = Counter(g for text in background for g in grams(text))
    names_of = set().union(*(grams(s) for sentences in TEMPLATES.values() for s in sentences))
    names_of = sorted(g for g in names_of if often[g] <= COMMON * len(background) and re.search("[a-z]", g))
    place = {g: k for k, g in enumerate(names_of)}
    x = np.zeros((len(texts), len(names_of)))
    for row, text in zip(x, texts):
        row[[place[g] for g in grams(text) if g in place]] = 1
    owner, held = np.array(owner), np.arange(len(texts)) % 4 == 0
    out = []
    for k, name in enumerate(names):
        y = (owner == k).astype(float)
        w, b = _fit(x[~held], y[~held])
        # Platt's calibration on the held-out paragraphs, with his smoothed targets
        z, hit = x[held] @ w + b, y[held]
        target = np.where(hit > 0, (hit.sum() + 1) / (hit.sum() + 2), 1 / ((1 - hit).sum() + 2))
        scale, shift = 1.0, 0.0
        for _ in range(2000):
            error = 1 / (1 + np.exp(-(scale * z + shift))) - target
            scale, shift = max(scale - 0.2 * (error * z).mean(), 1e-3), shift - 0.2 * error.mean()
        out.append(Family(name, {g: float(scale * w[i]) for g, i in place.items() if abs(w[i]) > 1e-6}, float(scale * b + shift)))
    return out, often


def _let(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def _words(paragraph: Column) -> Column:
    return F.regexp_extract_all(F.lower(paragraph), F.lit("([a-z0-9]+)"), 1)


def _around(lines: Column, i: Column) -> Column:
    """The words of line i (1-based) of the words of ``lines``, with as many of the lines around it, up to
    one without words, as the longest template has."""
    none = F.array().cast("array<string>")
    before = F.aggregate(
        F.slice(lines, F.greatest(i - REACH, F.lit(1)), F.least(i - 1, F.lit(REACH))), none,
        lambda got, w: F.when(F.size(w) == 0, none).otherwise(F.concat(got, F.slice(w, F.greatest(F.size(w) - REACH + 1, F.lit(1)), REACH))),
    )
    after = F.aggregate(
        F.slice(lines, i + 1, REACH), F.struct(none.alias("got"), F.lit(True).alias("on")),
        lambda x, w: F.struct(
            F.when(x.on, F.concat(x.got, F.slice(w, 1, REACH))).otherwise(x.got).alias("got"), (x.on & (F.size(w) > 0)).alias("on")
        ),
        lambda x: x.got,
    )
    before = _let(before, lambda w: F.slice(w, F.greatest(F.size(w) - REACH + 1, F.lit(1)), REACH))
    return F.concat(before, F.element_at(lines, i), F.slice(after, 1, REACH))


def _scored(words: Column, families: list[Family]) -> Column:
    """(family, probability, similarity, confirmed) of a paragraph's words: the likeliest family's,
    then those of every other confirmed one."""
    # constants go in as one text each, which the optimizer folds into one literal
    every = sorted(set().union(*(f.weights for f in families)))
    weights = {g: [f.weights.get(g, 0.0) for f in families] for g in every}
    table = F.from_json(F.lit(json.dumps(weights)), "map<string,array<double>>")
    start = F.from_json(F.lit(json.dumps([f.intercept for f in families])), "array<double>")
    names = F.from_json(F.lit(json.dumps([f.name for f in families])), "array<string>")
    pairs = [[sorted(g for g in grams(s) if g.count(" ") == 1) for s in TEMPLATES[f.name]] for f in families]
    pairs_of = F.from_json(F.lit(json.dumps(pairs)), "array<array<array<string>>>")

    def run(words: Column, n: int) -> Column:
        joined = F.transform(words, lambda w, i: F.concat_ws(" ", F.slice(words, i + 1, n)))
        return F.filter(joined, lambda g, i: i <= F.size(words) - n)

    def weigh(all_: Column) -> Column:
        known = F.filter(F.transform(F.array_distinct(all_), lambda g: F.element_at(table, g)), lambda w: w.isNotNull())
        return F.aggregate(known, start, lambda sum_, w: F.zip_with(sum_, w, lambda a, b: a + b))

    def like(own: Column, k: Column) -> Column:
        return F.array_max(
            F.transform(F.element_at(pairs_of, k), lambda pairs: F.size(F.array_intersect(pairs, own)) / F.greatest(F.size(pairs), F.lit(1)))
        )

    def probability(logit: Column) -> Column:
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))

    def one(k: Column, logit: Column, own: Column) -> Column:
        sure = probability(logit) >= LEAST
        return _let(like(own, k), lambda similar: F.struct(
            F.when(sure, F.element_at(names, k)).otherwise(F.lit("unknown")).alias("family"),
            probability(logit).alias("probability"), similar.alias("similarity"), (sure & (similar >= SIMILAR)).alias("confirmed"),
        ))

    def verdicts(own: Column, logits: Column) -> Column:
        best = F.array_position(logits, F.array_max(logits)).cast("int")
        first = one(best, F.array_max(logits), own)
        sure = F.filter(F.sequence(F.lit(1), F.size(logits)), lambda k: (k != best) & (probability(F.element_at(logits, k)) >= LEAST))
        more = F.filter(F.transform(sure, lambda k: one(k, F.element_at(logits, k), own)), lambda v: v.confirmed)
        return F.concat(F.array(first), more)

    return _let(
        words, lambda w: _let(run(w, 2), lambda own: _let(weigh(F.concat(w, own, run(w, 3))), lambda logits: verdicts(own, logits)))
    )


def _gate(families: list[Family], often: Counter) -> str:
    """A regular expression that fits every paragraph with a positive weight: of each such n-gram, its rarest word."""
    need = {min(g.split(), key=lambda w: (often[w], -len(w), w)) for f in families for g, w in f.weights.items() if w > 0}
    return r"(?i)(?<![a-z0-9])(?:" + "|".join(sorted(need)) + r")(?![a-z0-9])"


def background(docs: DataFrame, id_col: str, text_col: str) -> list[str]:
    """At most ``BACKGROUND`` paragraphs without the words licence and copyright, one of each of the documents of
    least hash.  Only hashes are ordered over all documents; texts are read of the chosen ones."""
    first = F.filter(F.split(text_col, "\n"), lambda p: p.rlike(r"[a-zA-Z0-9]") & ~p.rlike(r"(?i)licen[cs]e|copyright"))
    texts = docs.where(F.col(text_col).isNotNull()).select(F.xxhash64(id_col).alias("h"), F.col(text_col))
    least = texts.select("h").orderBy("h").limit(BACKGROUND).agg(F.max("h")).first()[0]
    if least is None:
        return []
    rows = texts.where(F.col("h") <= least).select("h", F.substring(F.get(first, 0), 1, LONGEST).alias("p")).where("p is not null")
    return [r.p for r in rows.orderBy("h", "p").limit(BACKGROUND).collect()]


def scan_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Licence notices of every whole text.

    A paragraph is a line with a word.  Returns one row per input row: doc_id,
    n_paragraphs, found (array of paragraph (1-based line), family, probability,
    similarity, confirmed; the family is ``unknown`` below the calibrated limit)
    for the paragraphs that hold a word of a positive weight and reach a
    probability of 0.1, and families (sorted confirmed families).  found has the
    likeliest family of a line and every other confirmed one; a notice that is
    wrapped over lines without an empty one between is scored with the words around
    such a line, and comes once, at the first of its lines, if no single line near
    confirms its family.  Null and empty
    texts have no paragraphs; null ids and repeated rows come back; other columns
    are ignored; an empty table gives no rows.
    """
    families, often = train(background(docs, id_col, text_col))
    assert all(f.intercept < 0 for f in families)  # without positive weights no family is reached
    gate = _gate(families, often)
    lines = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")
    fields = ("family", "probability", "similarity", "confirmed")
    at = F.filter(F.transform(lines, lambda p, i: F.struct((i + 1).alias("paragraph"), p.alias("p"))), lambda x: x.p.rlike(gate))

    def scored(numbers: Column, words_of) -> Column:
        every = lambda i: F.transform(
            _scored(words_of(i), families), lambda v: F.struct(i.alias("paragraph"), *(v[c].alias(c) for c in fields))
        )
        return F.flatten(F.transform(numbers, every))

    def wrapped(words: Column, numbers: Column, found: Column) -> Column:
        """``found`` with the notices that only a line with its neighbours confirms, each once."""
        some = F.filter(numbers, lambda i: (F.size(F.get(words, i - 2)) > 0) | (F.size(F.get(words, i)) > 0))
        wide = F.filter(scored(some, lambda i: _around(words, i)), lambda v: v.confirmed)
        near = lambda x, v: (x.family == v.family) & x.confirmed & (F.abs(x.paragraph - v.paragraph) <= REACH)
        wide = F.filter(wide, lambda v: ~F.exists(found, lambda x: near(x, v)))
        first = _let(wide, lambda all_: F.filter(all_, lambda v: ~F.exists(all_, lambda x: near(x, v) & (x.paragraph < v.paragraph))))
        more = lambda m: F.when(F.size(m) > 0, F.array_sort(F.concat(found, m))).otherwise(found)
        return _let(first, more)

    def notices(numbers: Column, words: Column) -> Column:
        single = F.filter(scored(numbers, lambda i: F.element_at(words, i)), lambda v: v.probability >= 0.1)
        return _let(single, lambda found: wrapped(words, numbers, found))

    none = F.expr("cast(array() as array<struct<paragraph: int, family: string, probability: double, similarity: double, confirmed: boolean>>)")
    found = _let(
        F.transform(at, lambda x: x.paragraph),
        lambda numbers: F.when(F.size(numbers) == 0, none).otherwise(_let(F.transform(lines, _words), lambda words: notices(numbers, words))),
    )
    one = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.size(F.filter(lines, lambda p: p.rlike(r"[^\x20\x09-\x0D]"))).cast("long").alias("n_paragraphs"), found.alias("found"),
    )
    confirmed = F.transform(F.filter("found", lambda x: x.confirmed), lambda x: x.family)
    return one.withColumn("families", F.sort_array(F.array_distinct(confirmed)))
