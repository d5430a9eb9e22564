import random

import numpy as np
import pytest

from vaultscope.llm import tokens
from vaultscope.llm.substrings import compacted, minimizers, remove_repeats, repeated_spans


def brute(rows, size):
    starts = {}
    split = [(d, (t or "").encode().split()) for d, t in rows]
    for d, w in split:
        if d is not None:
            for i in range(len(w) - size + 1):
                key = tuple(w[i : i + size])
                starts[key] = min(d, starts.get(key, d))
    out = []
    for d, w in split:
        gone = set()
        if d is not None:
            for i in range(len(w) - size + 1):
                if starts[tuple(w[i : i + size])] < d:
                    gone.update(range(i, i + size))
        out.append((d, " ".join(x.decode() for i, x in enumerate(w) if i not in gone), len(w), len(gone)))
    return sorted(out, key=str)


def got(df, size):
    return sorted(((r.doc_id, bytes(r.text).decode(), r.n_words, r.n_removed) for r in remove_repeats(df, size).collect()), key=str)


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, pos int, spans string")


def test_minimizers_against_brute_force():
    rng = random.Random(4)
    texts = [" ".join(rng.choice("abcd") for _ in range(rng.randrange(0, 70))).encode() for _ in range(40)]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    words, first = tokens.word_hashes(data, offsets)
    least, whole = minimizers(words, first, 12)
    runs = tokens.windows(words, 4)
    starts = [j for a, b in zip(first[:-1], first[1:]) for j in range(a, b - 12 + 1)]
    assert starts == list(np.flatnonzero(whole)) and starts
    assert all(least[j] == runs[j : j + 9].min() for j in starts)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_passages(spark, seed):
    rng = random.Random(seed)
    passages = [" ".join(f"p{rng.randrange(30)}" for _ in range(rng.randrange(5, 40))) for _ in range(8)]
    rows = []
    for d in range(120):
        parts = [rng.choice(passages) if rng.random() < 0.6 else " ".join(f"w{rng.randrange(2000)}" for _ in range(rng.randrange(0, 30))) for _ in range(4)]
        rows.append((d * 7 % 120, rng.choice([" ", "\n", "\t "]).join(parts)))
    assert got(table(spark, rows), 12) == brute(rows, 12)


def test_spans_are_equal_at_both_places(spark):
    rng = random.Random(9)
    base = [f"b{rng.randrange(50)}" for _ in range(300)]
    rows = [(d, " ".join(base[rng.randrange(100) : rng.randrange(150, 300)] + [f"u{d}"] + base[50:120])) for d in range(30)]
    words = {d: t.split() for d, t in rows}
    spans = repeated_spans(table(spark, rows), 20).collect()
    assert spans
    for s in spans:
        assert s.n >= 20 and s.source < s.doc
        assert words[s.doc][s.pos : s.pos + s.n] == words[s.source][s.source_pos : s.source_pos + s.n]


def test_periodic_text_and_copies(spark):
    rows = [(1, "a b " * 200), (2, "b a " * 200), (3, "a " * 400), (4, "a " * 400), (5, "a b " * 200), (0, "c " * 11 + "a " * 12)]
    assert got(table(spark, rows), 12) == brute(rows, 12)


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(None, long), (1, None), (2, ""), (3, " \n"), (7, long), (7, long), (9, "x " + long), (8, long[:50_000]), (4, "é ü \x1c z")]
    assert got(table(spark, rows), 50) == brute(rows, 50)
    assert got(table(spark, rows).limit(0), 50) == []


def test_two_texts_under_one_doc_id(spark):
    """A span of one text takes no word from the other texts of its doc_id."""
    rows = [(1, "a " * 60), (5, "a " * 60), (5, "b " * 60), (5, "a " * 55 + "c"), (9, "b " * 51), (0, "z")]
    for order in (rows, rows[::-1]):
        assert got(table(spark, order), 50) == brute(order, 50)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_paths_against_a_plain_graph(spark, seed):
    """Compaction of a random graph with branches, chains over several sources and cycles."""
    rng = random.Random(seed)
    nodes, edges, used = 60, [], set()
    for source in range(12):
        at = rng.randrange(nodes)
        for pos in range(rng.randrange(1, 30)):
            to = (at + 1) % nodes if rng.random() < 0.9 else rng.randrange(nodes)
            if (at, to) not in used:
                used.add((at, to))
                edges.append((source, pos, at, to))
            at = to
    edges += [(50, k, 1000 + k, 1000 + (k + 1) % 7) for k in range(7)] + [(51, 0, 2000, 2000)]
    into, out = {}, {}
    for s, p, a, b in edges:
        out.setdefault(a, []).append((s, p))
        into.setdefault(b, []).append((s, p))
    root = {(s, p): (s, p) for s, p, *_ in edges}

    def find(e):
        while root[e] != e:
            e = root[e]
        return e

    for node, came in into.items():
        if len(came) == len(out.get(node, [])) == 1:
            x, y = find(came[0]), find(out[node][0])
            root[max(x, y)] = min(x, y)
    want = {}
    for e in root:
        want.setdefault(find(e), set()).add(e)
    have = {}
    for r in compacted(spark.createDataFrame(edges, "source long, source_pos int, l long, r long")).collect():
        have.setdefault(r.path, set()).add((r.source, r.source_pos))
    assert sorted(map(sorted, have.values())) == sorted(map(sorted, want.values()))
    assert max(map(len, want.values())) > 3 and len(want) > 5
