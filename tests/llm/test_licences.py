import re
from collections import Counter

import numpy as np
import pytest

from vaultscope.llm import licences as L


def plain(families, text):
    """The scan of one paragraph without Spark."""
    own = L.grams(text)
    logits = [f.intercept + sum(w for g, w in f.weights.items() if g in own) for f in families]
    k = int(np.argmax(logits))
    p = 1 / (1 + np.exp(-logits[k]))
    pairs = {g for g in own if g.count(" ") == 1}
    like = max(len({g for g in L.grams(s) if g.count(" ") == 1} & pairs) / len({g for g in L.grams(s) if g.count(" ") == 1}) for s in L.TEMPLATES[families[k].name])
    family = families[k].name if p >= L.LEAST else "unknown"
    return family, p, like, family != "unknown" and like >= L.SIMILAR


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def trained(docs):
    return L.train(L.background(docs, "doc_id", "text"))


def test_weights_are_sparse_and_the_gate_holds(trained):
    families, often = trained
    gate = re.compile(L._gate(families, often))
    every = set().union(*(L.grams(s) for v in L.TEMPLATES.values() for s in v))
    for f in families:
        assert f.intercept < 0 and len(f.weights) < len(every) / 2
        assert all(gate.search(g) for g, w in f.weights.items() if w > 0)


def test_held_out_notices(trained):
    families, _ = trained
    notices = {
        "This file is Licensed under the Apache License, Version 2.0, see below": "apache",
        "foo bar - Released under the MIT License - baz": "mit",
        "our texts are licensed under CC BY-NC 4.0 since spring": "cc-by-nc",
        "our texts are licensed under CC BY-SA 4.0 since spring": "cc-by-sa",
        "The tool is free software under the GNU General Public License": "gpl",
        "You need a driving licence for this": "unknown",
        "All rights reserved by the authors of this book": "unknown",
        "erst the thing of a river and stone": "unknown",
    }
    assert {t: plain(families, t)[0] for t in notices} == notices


def test_whole_table_against_plain_python(spark, docs, trained):
    families, _ = trained
    want, rows = {}, L.scan_licences(docs).collect()
    for r in docs.collect():
        found = [(n + 1, *plain(families, p)) for n, p in enumerate((r.text or "").split("\n"))]
        want[r.doc_id] = [f for f in found if f[2] >= 0.1]
    assert len(rows) == len(want)
    for r in rows:
        assert [(f.paragraph, f.family, f.confirmed) for f in r.found] == [(f[0], f[1], f[4]) for f in want[r.doc_id]]
        assert np.allclose([f.probability for f in r.found], [f[2] for f in want[r.doc_id]])
        assert np.allclose([f.similarity for f in r.found], [f[3] for f in want[r.doc_id]])
        assert r.families == sorted({f[1] for f in want[r.doc_id] if f[4]})
    assert len(Counter(x for r in rows for x in r.families)) == 4


def test_odd_rows(spark):
    notice = "Released under the MIT License."
    rows = [(None, notice, "x"), (1, None, "x"), (2, "", "x"), (3, f"a\n\n{notice}", "x"), (3, f"a\n\n{notice}", "x"), (4, "word " * 50_000 + notice, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, found string")
    out = sorted(((r.doc_id, r.n_paragraphs, [f.paragraph for f in r.found], r.families) for r in L.scan_licences(df).collect()), key=str)
    assert out == [(1, 0, [], []), (2, 0, [], []), (3, 2, [3], ["mit"]), (3, 2, [3], ["mit"]), (4, 1, [1], ["mit"]), (None, 1, [1], ["mit"])]
    assert L.scan_licences(df.limit(0)).count() == 0


WRAPPED = {
    "gpl": "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation",
    "bsd": " * Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided that the following conditions\n * are met:",
    "mit": "Permission is hereby\ngranted, free of\ncharge, to any person\nobtaining a copy of\nthis software and\nassociated\ndocumentation files",
}


def test_wrapped_notices(spark, docs):
    rows = [(n, f"some words\n\n{text}\n\nof stone") for n, text in enumerate(WRAPPED.values())]
    rows += [(10, WRAPPED["gpl"].replace("\n", "\n\n")), (11, "Released under the MIT License. " + "river stone " * 30 + "Licensed under the Mozilla Public License, version 2.0.")]
    rows += [(12, "\n".join(["Released under the MIT License.", "x", *WRAPPED.values()]))]
    df = docs.select("doc_id", "text").where("doc_id > 100").union(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))
    out = {r.doc_id: r for r in L.scan_licences(df).where("doc_id <= 12").collect()}
    assert [out[n].families for n in range(3)] == [[f] for f in WRAPPED]
    assert [sum(f.confirmed for f in out[n].found) for n in range(3)] == [1, 1, 1]
    assert out[10].families == [] and out[11].families == ["mit", "mpl"] and out[12].families == ["bsd", "gpl", "mit"]
