"""Every stage of the pipeline against brute force on its own input."""

import re
from collections import Counter

import pytest
import test_linededup as line_rows
import test_quality as quality_rows

import corpus_pipeline
from vaultscope.llm.mixing import mix_sources
from vaultscope.llm.shared import table

PATH = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    docs = [spark.read.parquet(f"{PATH}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        docs.append(table(stage(spark, docs[-1], PATH)))
    return docs


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near_dedup", "mixing", "encoding"]
    assert all(d.columns == stages[0].columns and d.dtypes == stages[0].dtypes for d in stages[:-1])


def test_quality(stages):
    want = [r for r in rows(stages[0]) if not quality_rows.brute(r[1])[-1]]
    assert rows(stages[1]) == want and 0 < len(want) < stages[0].count()


def test_lines(stages):
    before = {r.doc_id: r for r in stages[1].collect()}
    want = line_rows.brute([(r.doc_id, r.text) for r in before.values()])
    have = {r.doc_id: r for r in stages[2].collect()}
    assert {d: t for d, t, *_ in want} == {d: r.text for d, r in have.items()}
    assert all(r.n_chars == len(r.text) and (r.lang, r.source) == (before[d].lang, before[d].source) for d, r in have.items())


def brute_groups(texts, size):
    sets = {}
    for doc, text in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", text.translate({c: c + 32 for c in range(65, 91)}))
        sets[doc] = {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: find(d) for d in ids}


def test_near_dedup(stages):
    groups = brute_groups({r.doc_id: r.text for r in stages[2].collect()}, 5)
    want = {d for d, g in groups.items() if d == g}
    assert {r.doc_id for r in stages[3].collect()} == want and len(want) < len(groups)


def test_mixing(stages):
    taken = {r.doc_id: r for r in mix_sources(stages[3]).collect()}
    copies = Counter(r.doc_id for r in stages[4].collect())
    assert all(copies[d] * r.size == r.taken for d, r in taken.items())
    assert set(rows(stages[4])) <= set(rows(stages[3]))


def test_encoding(stages):
    import base64

    import public_tokenizers as P
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    text = {r.doc_id: r.text for r in stages[4].collect()}
    out = stages[5].collect()
    assert len(out) == stages[4].count()
    for r in out:
        assert r.text == text[r.doc_id] and r.ids == library.encode_ordinary(r.text) and r.n_tokens == len(r.ids)


def test_run_is_the_same(spark, stages):
    assert Counter(r.doc_id for r in corpus_pipeline.run(spark, PATH).collect()) == Counter(r.doc_id for r in stages[5].collect())


def test_empty_and_odd_documents(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    good = " ".join(f"w{i}" for i in range(70))
    odd = [(None, good + " a", None, None, None), (1, None, "en", "a", 0), (2, "", "en", None, 0), (3, good, None, "a", 5), (3, good, None, "a", 5)]
    for data in ([], odd):
        docs = spark.createDataFrame(data, schema)
        for name, stage in corpus_pipeline.STAGES:
            docs = table(stage(spark, docs, PATH))
            if name == "near_dedup":  # repeated rows and a null id are near-duplicates like others: one row stays
                assert [r.doc_id for r in docs.collect()] == ([3] if data else [])
        assert {r.doc_id for r in docs.collect()} == ({3} if data else set())
