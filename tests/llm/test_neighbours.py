import math
import random

import numpy as np
import pytest

from vaultscope.llm import neighbours
from vaultscope.llm.neighbours import Tree, nearest_neighbours, search


def brute(rows, queries, k):
    good = {}
    for i, v in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] or [])):
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            good.setdefault(i, np.array(v, float))
    out = []
    for q in sorted({i for i in queries if i in good}):
        near = sorted(((-float(good[q] @ v), i) for i, v in good.items() if i != q))[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(near)]
    return out


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string")


def got(spark, rows, queries, k=5):
    df = table(spark, rows)
    out = nearest_neighbours(df, df.where(df.vec_id.isin(queries)), k)
    return [tuple(r) for r in out.orderBy("query_id", "rank").collect()]


def test_leaves_partition_and_search_reaches_all():
    random_ = np.random.RandomState(1)
    sample = random_.randn(2000, 9)
    tree = Tree.fit(sample, 50, random_)
    leaf = tree.leaves(sample)
    assert np.bincount(leaf).max() <= 50 and np.bincount(leaf).min() > 0
    found = search([tree, Tree.fit(sample, 50, random_)], sample[7], 10**6)
    assert len(found) == len(set(found)) and {x for t, x in found if t == 0} == set(leaf)
    assert found[0][1] == tree.leaves(sample[7:8])[0] or found[1][1] == tree.leaves(sample[7:8])[0]


def test_alike_sample_is_one_leaf():
    assert len(Tree.fit(np.ones((500, 3)), 10, np.random.RandomState(0)).planes) == 0


def test_small_tables_are_exact(spark):
    rng = random.Random(3)
    rows = [(i, [round(rng.gauss(0, 1), 2) for _ in range(4)]) for i in range(60)]
    rows += [(i, [1.0, 0.5, 0.0, 0.0]) for i in range(100, 140)]  # equal vectors: ties by id
    rows += [(200, None), (201, []), (202, [0.0] * 4), (203, [1.0, None, 1.0, 1.0]), (204, [float("nan"), 1.0, 1.0, 1.0])]
    rows += [(205, [float("inf"), 1.0, 1.0, 1.0]), (None, [9.0] * 4), (20, rows[20][1])]
    queries = [0, 20, 40, 100, 120, 200, 202, 204]
    want, have = brute(rows, queries, 5), got(spark, rows, queries)
    assert [w[:3] for w in want] == [h[:3] for h in have]
    assert [h[3] for h in have] == pytest.approx([float(np.float64(w[3])) for w in want], rel=1e-6)


def test_fewer_candidates_than_asked_and_empty(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.5, 1.0]), (20, [1.0, 1.0])]
    assert [r[:3] for r in got(spark, rows, [20])] == [(20, 1, 2), (20, 2, 1)]
    assert got(spark, rows[:1], [1]) == []
    df = table(spark, rows).limit(0)
    assert nearest_neighbours(df, df).count() == 0


def test_other_widths_take_no_part(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.5, 1.0]), (3, [1.0, 1.0, 1.0]), (20, [1.0, 1.0])]
    assert [r[:3] for r in got(spark, rows, [20, 3])] == [(20, 1, 2), (20, 2, 1)]


def test_blocks_of_a_leaf(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1) for _ in range(3)]) for i in range(120)]
    queries = list(range(0, 120, 4))
    want = got(spark, rows, queries)
    monkeypatch.setattr(neighbours, "SIDE", 16)
    have = got(spark, rows, queries)
    assert [h[:3] for h in have] == [w[:3] for w in want]


def test_recall_on_the_whole_table(spark):
    from vaultscope.llm.queries import op7_nearest_neighbours

    path = "/root/testdata/sf0.1"
    data = spark.read.parquet(f"{path}/embeddings.parquet").toPandas()
    vectors, ids = np.stack(data.embedding.values).astype(float), data.vec_id.values
    have = op7_nearest_neighbours(spark, path).toPandas()
    assert sorted(have.query_id.unique()) == sorted(i for i in ids if i % 20 == 0)
    hits = []
    for q, x in have.groupby("query_id"):
        score = vectors @ vectors[ids == q][0]
        score[ids == q] = -np.inf
        hits.append(len(set(ids[np.lexsort((ids, -score))[:20]]) & set(x.vec_id)) / 20)
    assert np.mean(hits) >= 0.9
