import random
import re

import numpy as np
import pyarrow as pa
import pytest

from vaultscope.llm import linking, tokens
from vaultscope.llm.neardup import lost, near_duplicates, one_of_each_group
from vaultscope.llm.shared import components


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def brute(rows, size, percent=80):
    """Rows of one doc_id are one document, linked where any of its texts is."""
    texts = [(d, shingles(t, size)) for d, t in rows if d is not None]
    root = {d: d for d, _ in texts}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for n, (a, s) in enumerate(texts):
        for b, t in texts[n + 1 :]:
            both = len(s & t)
            if both and 100 * both >= percent * (len(s) + len(t) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    out = []
    for d, t in rows:
        own = shingles(t, size)
        group = None if d is None else find(d) if own else d
        out.append((d, len(own), group, d is None or d == group))
    return sorted(out, key=str)


def table(spark, rows):
    return spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, component_id int, doc string")


def got(df, size):
    return sorted(map(tuple, near_duplicates(df, size=size).collect()), key=str)


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return words


def corpus(seed, groups, members, length, edits):
    rng = random.Random(seed)
    rows = []
    for g in range(groups):
        base = [f"w{rng.randrange(10**6)}" for _ in range(length)]
        for _ in range(members):
            rows.append(" ".join(edited(rng, base, rng.randrange(edits + 1))))
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_components_against_union_find(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1200)] + [(None, 3), (5, 5)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    out = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in out} == {n: find(n) for n in root} and len(out) == len(root)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_shingle_sets_against_brute_force():
    rng = random.Random(6)
    texts = [" ".join(rng.choice("abAB") for _ in range(rng.randrange(0, 15))) for _ in range(60)] + ["\x1c   x", "é É"]
    raw = [t.encode() for t in texts]
    values, at = tokens.shingle_sets(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]), 4)
    names = {}
    for text, a, b in zip(texts, at[:-1], at[1:]):
        own = shingles(text, 4)
        assert b - a == len(own) and len(set(values[a:b].tolist())) == b - a
        key = frozenset(own)
        assert names.setdefault(key, values[a:b].tobytes()) == values[a:b].tobytes()
    assert len(set(names.values())) == len(names)


@pytest.mark.parametrize("seed", [1, 2])
def test_edited_copies(spark, seed):
    rows = corpus(seed, 12, 8, 60, 5)
    want = brute(rows, 4)
    assert got(table(spark, rows), 4) == want
    assert len({w[2] for w in want}) < len(rows)


def test_large_group_goes_through_blocks(spark, monkeypatch):
    """A hot group whose members are partly linked through each other only."""
    monkeypatch.setattr(linking, "SIDE", 16)
    rows = corpus(4, 1, 120, 80, 7) + [(1000 + d, t) for d, t in corpus(5, 2, 20, 50, 4)]
    want = brute(rows, 4)
    assert got(table(spark, rows), 4) == want
    assert len({w[2] for w in want}) > 3


def test_similarity_at_the_threshold(spark):
    words = [f"w{i}" for i in range(11)]  # 8 shingles of four words
    rows = [(1, " ".join(words)), (2, " ".join(words + ["x", "y"])), (3, " ".join(words + ["p", "q", "r"]))]
    assert got(table(spark, rows), 4) == brute(rows, 4) == [(1, 8, 1, True), (2, 10, 1, False), (3, 11, 3, True)]


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(50_000))
    rows = [(None, "a b c d e"), (None, None), (1, None), (2, ""), (3, " \n"), (4, "a"), (5, "A"), (6, "a b"), (7, "a b c d e"), (8, "A B c D e")]
    rows += [(9, long), (10, long + " end"), (11, "É b"), (12, "é b")]
    assert got(table(spark, rows), 4) == brute(rows, 4)
    twice = [(7, "a b c d e"), (7, "a b c d e"), (9, "a b c d e")]
    assert got(table(spark, twice), 4) == [(7, 2, 7, True), (7, 2, 7, True), (9, 2, 7, False)]
    assert got(table(spark, rows).limit(0), 4) == []


def test_one_document_with_several_texts(spark):
    """Both texts of document 5 have a copy; whatever their order, both copies are linked to 5."""
    a, b = (" ".join(f"{c}{i}" for i in range(30)) for c in "ab")
    rows = [(5, a), (5, b), (7, a + " z"), (8, b + " z"), (9, a), (9, None), (4, "c d e f g")]
    for order in (rows, rows[::-1]):
        assert got(table(spark, order), 4) == brute(order, 4)
    assert {(r[0], r[2]) for r in brute(rows, 4)} == {(5, 5), (7, 5), (8, 5), (9, 5), (9, 9), (4, 4)}


def test_one_of_each_group(spark):
    text, other = (" ".join(f"{c}{i}" for i in range(30)) for c in "ab")
    rows = [(5, text), (5, text), (None, text), (None, text), (9, text + " z"), (None, other), (None, other), (3, None), (3, ""), (None, None)]
    docs = spark.createDataFrame([(d, t, n, "x") for n, (d, t) in enumerate(rows)], "doc_id long, text string, row int, `group` string")
    out = one_of_each_group(docs)
    assert out.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted([(5, text), (None, other), (3, None), (3, ""), (None, None)], key=str)
    assert one_of_each_group(docs.limit(0)).count() == 0


def test_blocks_against_all_pairs():
    """Every pair of components that a link joins is joined, and no more links than that."""
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**63, 60).astype(np.uint64)
    sets = []
    for _ in range(70):
        own = base.copy()
        own[rng.choice(60, rng.integers(0, 9), replace=False)] = rng.integers(0, 2**63, 1).astype(np.uint64)
        sets.append(np.unique(own))
    for stray in (np.arange(70) < 40, np.arange(70) < 3):
        comp = np.arange(70) // 2
        block = pa.table({"stray": stray, "node": np.arange(70), "comp": comp, "set": [s.tobytes() for s in sets]})
        out = linking.block_links(80)(block)

        def joined(pairs):
            root = {int(c): int(c) for c in comp}
            def find(c):
                while root[c] != c:
                    c = root[c]
                return c
            for a, b in pairs:
                x, y = sorted((find(int(comp[a])), find(int(comp[b]))))
                root[y] = x
            return {c: find(c) for c in root}

        every = [(a, b) for a in np.flatnonzero(stray) for b in np.flatnonzero(~stray) if linking.alike(sets[a], sets[b], 80)]
        links = list(zip(out["a"].to_pylist(), out["b"].to_pylist()))
        assert joined(links) == joined(every) and len(links) < 35 and len(every) > len(links)


def test_probability_of_a_lost_link():
    assert lost(0.8) < 1.2e-6
    assert all(lost(s) < lost(0.8) / 3 for s in (0.82, 0.85, 0.9, 0.99))


def test_bitmaps_never_rule_out_a_link():
    """At every size and threshold; and sets that only share a passage are ruled out."""
    rng = np.random.default_rng(8)
    fresh = lambda n: rng.integers(0, 2**64, n, dtype=np.uint64)
    left, right = [], []
    for n in [1, 2, 5, 31, 32, 33, 100, 127, 129, 1000] * 8:
        base = fresh(n)
        k = int(rng.integers(0, n // 4 + 1))
        left.append(np.unique(base))
        right.append(np.unique(np.concatenate([base[k:], fresh(int(rng.integers(0, n // 5 + 2)))])))
    for percent in (80, 85):
        may = linking.may_be_alike([linking.bitmap(x) for x in left], [linking.bitmap(x) for x in right], percent)
        links = np.array([[linking.alike(x, y, percent) for y in right] for x in left])
        assert links.sum() >= 15 and not (links & ~may).any()
    passage = fresh(40)
    docs = [np.unique(np.concatenate([passage, fresh(300)])) for _ in range(20)]
    bits = [linking.bitmap(x) for x in docs]
    assert np.array_equal(linking.may_be_alike(bits, bits, 80), np.eye(20, dtype=bool))
