import random
from collections import Counter, defaultdict

import pytest

from vaultscope.llm import mixing
from vaultscope.llm.mixing import mix_sources, mixed_documents


def targets(sizes):
    """Water filling, step by step."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    total, fixed = 1.5 * sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in fixed]
        level = (total - sum(fixed.values())) / (sum(weight[s] for s in open_) or 1)
        over = [s for s in open_ if weight[s] * level > 2 * sizes[s]]
        if not over:
            return fixed | {s: weight[s] * level for s in open_}
        fixed |= {s: 2.0 * sizes[s] for s in over}


def rows_of(seed, n=600):
    rng = random.Random(seed)
    names = [None, "a", "B", "é", "\U0001f600", "zz", "ﬀ"]
    weights = [1, 30, 1, 5, 2, 1, 1]
    return [(k, " ".join(["w"] * rng.randrange(0, 60)), rng.choices(names, weights)[0], 0.5) for k in range(n)]


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, target double")


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_and_nearness(spark, seed):
    rows = rows_of(seed)
    df = table(spark, rows)
    out = mix_sources(df).collect()
    assert sorted((r.doc_id, r.size) for r in out) == sorted((k, len(t.split())) for k, t, *_ in rows)
    source = {k: s for k, _, s, _ in rows}
    sizes, taken = Counter(), Counter()
    for r in out:
        sizes[source[r.doc_id]] += r.size
        taken[source[r.doc_id]] += r.taken
        assert r.taken in (0, r.size, 2 * r.size)
    want = targets(sizes)
    for r in out:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s], rel=1e-12)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 30.5  # half the largest document
    assert sorted(map(tuple, out)) == sorted(map(tuple, mix_sources(df.repartition(7)).collect()))
    copies = Counter(r.doc_id for r in mixed_documents(df).collect())
    assert all(copies[r.doc_id] * r.size == r.taken for r in out)
    assert mixed_documents(df).columns == df.columns


def test_complete_epochs_first(spark):
    rows = [(k, "w " * 10, "big" if k < 90 else "small", 0.0) for k in range(100)]
    by = defaultdict(set)
    for r in mix_sources(table(spark, rows)).collect():
        by["big" if r.doc_id < 90 else "small"].add(r.taken)
    assert by["small"] == {20} and by["big"] == {10, 20}


def test_quality_weight_moves_the_sample(spark):
    clean, dirty = "word " * 20, "12# $%& " * 20
    rows = [(k, clean if k % 2 else dirty, "a", 0.0) for k in range(1000)] + [(9999, "w " * 400, "b", 0.0)]
    more = Counter(r.doc_id % 2 for r in mix_sources(table(spark, rows), share=0.5).collect() if r.doc_id < 9999 and r.taken)
    assert more[1] > 2 * more[0]


def test_bucket_cut_does_not_matter(spark, monkeypatch):
    df = table(spark, rows_of(3))
    want = sorted(map(tuple, mix_sources(df).collect()))
    monkeypatch.setattr(mixing, "BUCKETS", 3)
    assert sorted(map(tuple, mix_sources(df).collect())) == want


def test_odd_rows(spark):
    rows = [(None, "a b", None, 0.0), (1, None, "x", 0.0), (2, "", "x", 0.0), (3, "a " * 1000, "y", 0.0), (3, "a " * 1000, "y", 0.0)]
    out = sorted((r.doc_id or 0, r.size, r.source_size, r.taken) for r in mix_sources(table(spark, rows)).collect())
    assert [o[:3] for o in out] == [(0, 2, 2), (1, 0, 0), (2, 0, 0), (3, 1000, 2000), (3, 1000, 2000)]
    assert all(o[3] <= 2 * o[1] for o in out)
    empty = table(spark, rows).limit(0)
    assert mix_sources(empty).count() == 0 and mixed_documents(empty).count() == 0
    blank = table(spark, [(1, None, "x", 0.0), (2, " ", None, 0.0)])
    assert [(r.size, r.target, r.taken) for r in mix_sources(blank).collect()] == [(0, 0.0, 0)] * 2


@pytest.mark.parametrize("ids", [[None], [7], [None, 7, 8]])
def test_ties_of_any_size_are_cut(spark, ids):
    """1,000 rows that share few doc_ids and one size land within half a document of the target."""
    rows = [(ids[k % len(ids)], "w " * 10, "a", 0.0) for k in range(1000)] + [(50_000 + k, "w " * 10, "b", 0.0) for k in range(200)]
    df = table(spark, rows)
    out = mix_sources(df, share=0.6).collect()
    for size, n in ((10_000, 1000), (2000, 200)):
        own = [r for r in out if r.source_size == size]
        assert len(own) == n and abs(sum(r.taken for r in own) - own[0].target) <= 5
    taken = Counter()
    for r in out:
        taken[r.doc_id] += r.taken
    copies = Counter(r.doc_id for r in mixed_documents(df, share=0.6).collect())
    assert {d: 10 * c for d, c in copies.items()} == {d: t for d, t in taken.items() if t}


def test_sample_against_brute_force(spark):
    """``taken`` is what sorting each source by its documents' keys gives."""
    rows = rows_of(5)
    df = table(spark, rows)
    key = {r.doc_id: (r.m.key, r.doc_id) for r in df.select("doc_id", mixing._measured(df.text, df.doc_id, 0).alias("m")).collect()}
    out = {r.doc_id: r for r in mix_sources(df).collect()}
    for name in {s for _, _, s, _ in rows}:
        ids = sorted((k for k, _, s, _ in rows if s == name), key=key.get)
        target, size = out[ids[0]].target, sum(out[k].size for k in ids)
        epochs = int(target // size) if size else 0
        rest, upto = target - epochs * size, 0
        for k in ids:
            last = upto + out[k].size / 2 <= rest
            upto += out[k].size
            assert out[k].taken == out[k].size * (epochs + last)


def test_clashing_names(spark):
    names = ["mark", "plan", "row", "copy", "__mark", "__plan", "__copy", "source_size", "key"]
    df = table(spark, rows_of(6, 60)).selectExpr("*", *(f"doc_id as `{n}`" for n in names))
    out = mixed_documents(df)
    assert out.columns == df.columns and all(r[n] == r.doc_id for r in out.collect() for n in names)
    assert mix_sources(df).count() == 60
