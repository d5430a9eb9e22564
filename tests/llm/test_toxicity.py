import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from vaultscope.llm import toxicity as T

BASE = "the idiot and the loser and the moron are here with a clown or some trash that is pathetic and disgusting scum stupid worthless "


@pytest.fixture(scope="module")
def restorer():
    batch = next(T._count(iter([pa.record_batch({"text": pa.array([(BASE * 30).encode()])})])))
    counts = np.zeros(28**3, np.int64)
    counts[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    return T.Restorer(counts)


def read(restorer, *texts):
    return [b" ".join(x).decode() for x in restorer.restored(pa.array([t.encode() for t in texts], pa.binary()))]


def test_trigrams_don_t_cross_texts():
    batch = next(T._count(iter([pa.record_batch({"text": pa.array([b"ab", b"cd", None, b""], pa.binary())})])))
    assert (1 * 28 + 2) * 28 + 3 not in batch.column(0).to_pylist()


@pytest.mark.parametrize(
    "text, want",
    [
        ("an 1d10t", "an idiot"), ("a l0s3r!", "a loser"), ("l o s e r", "loser"), ("m.o.r.o.n", "moron"), ("I-D-I-O-T", "idiot"),
        ("stuuupid", "stupid"), ("iddiiiooot", "idiot"), ("tr@sh $cum", "trash scum"), ("cl0wn.", "clown"), ("plain words stay", "plain words stay"),
        ("", ""), ("12.50 ### $$$", ""),
    ],
)
def test_restored_readings(restorer, text, want):
    assert read(restorer, text) == [want]


def test_viterbi_equals_all_readings(restorer):
    def total(reading):
        cost, a, b, out = 0.0, 0, 0, ""
        for c, extra in reading:
            cost += extra
            if c and not (c == " " and b == 0):
                cost, a, b, out = cost + restorer.cost[a][b][T._kind(c)], b, T._kind(c), out + c
        return cost + restorer.cost[a][b][0], out

    for text in ("1d10t", "l0ss", "a b-b", "m0r0n", "i.d|0", "5ttt!p"):
        every = itertools.product(*(restorer._choices(text, i) for i in range(len(text))))
        assert restorer.decode(text) == min(map(total, every))[1]


def test_stretches_keep_to_their_text(restorer):
    assert read(restorer, "a b", "c d", "i d", "", "i o t") == ["a b", "c d", "i d", "", read(restorer, "i o t")[0]]
    long = "x" * 50_000 + " 1d10t " + "y z " * 3
    assert "idiot" in read(restorer, long)[0].split()


def test_held_out_quality(spark):
    from vaultscope.llm.queries import op2_toxicity

    path = "/root/testdata/sf0.1"
    rows = {r.doc_id: r for r in op2_toxicity(spark, path).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{path}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{path}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) and r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for d, r in rows.items())
    held = [(rows[d].predicted, t) for d, t in labels.items() if rows[d].held_out]
    hit = sum(p and t for p, t in held)
    assert hit >= 0.75 * sum(t for _, t in held) and hit >= 0.9 * sum(p for p, _ in held)


def test_odd_rows(spark):
    rng = random.Random(1)
    vocabulary = ["".join(rng.choice("bdfgklnprtuvw") + rng.choice("aeou") for _ in range(3)) for _ in range(500)]
    plain = lambda: " ".join(rng.choice(vocabulary) for _ in range(20))
    rows = [(k, plain() + (" idiot scumbag " + plain() if k % 4 == 0 else ""), "x", 0) for k in range(400)]
    labels = [(k, int(k % 4 == 0), "x") for k in range(400)] + [(5, None, "x"), (None, 1, "x"), (7, 0, "x")]
    rows += [(1000, None, "x", 0), (1001, "", "x", 0), (None, "idiot scumbag", "x", 0), (1002, "an 1d10t and a scumb@g", "x", 0)]
    rows += [(1003, "idiot scumbag", "x", 0)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic string, score int")
    labels = spark.createDataFrame(labels, "doc_id long, toxic int, text string")
    out = T.toxicity(docs, labels).collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out}
    assert by[None].predicted == 1 and not by[None].held_out
    assert by[1002].predicted == by[1003].predicted == 1 and by[1000].score == by[1001].score < 0.1
    assert all(by[k].predicted == int(k % 4 == 0) for k in range(400))
    assert T.toxicity(docs.limit(0), labels).count() == 0
    assert {r.score for r in T.toxicity(docs, labels.limit(0)).collect()} == {0.0}


def test_rare_entries_beside_many_ordinary_ones(spark):
    """Ordinary words of every toxic text give more than 20,000 candidates of larger support."""
    rng = random.Random(3)
    pool = sorted({"".join(rng.sample("abcdefghijklmnopqrstuvwxy", 8)) for _ in range(7_100)}, key=lambda w: zlib.crc32(w.encode()))
    marks, ordinary = pool[:40], pool[40:]  # a least word hash of its own for each text
    ids = [k for k in range(200) if zlib.crc32(str(k).encode()) % 3 != 1][:36]
    rows = []
    for n, k in enumerate(ids):
        rng.shuffle(ordinary)
        rows.append((k, " ".join([marks[n], *ordinary, *(["zodzod"] if n < 4 else [])])))
    docs = spark.createDataFrame([*rows, (1000, "a zodzod here"), (1001, "a " + " ".join(ordinary[:50]))], "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(n < 12)) for n, k in enumerate(ids)], "doc_id long, toxic int")
    by = {r.doc_id: r.score for r in T.toxicity(docs, labels).collect()}
    assert by[1000] > 0.6 and by[1001] < 0.1


@pytest.mark.parametrize(
    "text, want",
    [
        ("an 1 d 1 0 t", "an idiot"), ("s 7 u p 1 d", "stupid"), ("m . o . r . o . n", "moron"), ("1.d.1.0.t", "idiot"), ("the idio+", "the idiot"),
        ("\"i d i o t\", he", "idiot he"), ("m. 0. r. 0. n!", "moron"), ("i-d-1-0-+", "idiot"), ("scum!", "scum"), ("1 2 3 - 4", ""), ("a, b, c", "a b c"),
    ],
)
def test_mixed_disguises(restorer, text, want):
    assert read(restorer, text) == [want]


def test_doubled_letters_are_read_both_ways(restorer):
    assert read(restorer, "iidiioot") == ["iidiioot idiot"]
    assert read(restorer, "iidii0tt") == ["idiot"]
    assert {"ass", "pass"} <= set(read(restorer, "ass pass!")[0].split())
    assert read(restorer, "a", "a plain idio", "to", "x", "+end") == ["a", "a plain idio", "to", "x", read(restorer, "+end")[0]]
