"""Conversation repair against exhaustive search and a plain path search over strings."""

import hashlib
import random
import zlib

import pytest

from vaultscope.llm.conversations import WIDTH, damaged, repair_conversations, repaired_turns

SCHEMA = "conv_id long, turn long, role string, text string, copies int, conv string, place int"
ROLES = ["system", "user", "assistant", "user", "assistant", "tool", "", None]
TEXTS = ["Yes.", "No", "Why?", "", " \n", None, "é! ", "So "]
FOLLOWS = {"": "u", "s": "u", "u": "a", "a": "u"}
NAMES = {"u": "user", "a": "assistant"}


def faults(rows):
    """(role, text, fault) of a conversation's rows in order."""
    rows = sorted(((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows),
                  key=lambda z: (z[0] is not None, z[0] or 0, z[1].encode(), z[2].encode()))
    out, seen = [], set()
    for _, role, text in rows:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))
        out.append((role, text, fault))
    turns = [t for t, *_ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return out, gaps


def search(rows, inserts):
    """Least (cost, audit, lines); up to ``inserts`` inserts at a place."""
    best = {"": (0, "", ())}

    def grown(paths):
        out = dict(paths)
        for _ in range(inserts):
            for q, (c, a, o) in list(out.items()):
                to = FOLLOWS[q]
                new = (c + 2, a + "I", (*o, NAMES[to] + ":"))
                if to not in out or new < out[to]:
                    out[to] = new
        return out

    for role, text, fault in rows:
        new = {}
        every = [(q, p) for q, p in grown(best).items()]
        every += list(best.items())
        for q, (c, a, o) in every:
            steps = [(q, c + 3, a + "D", o)]
            if fault in (None, "truncated"):
                extra = fault is not None
                if role[:1] == FOLLOWS[q] or (q == "" and role[:1] == "s"):
                    steps.append((role[:1], c + extra, a + "K", (*o, f"{role}:{text}")))
                steps.append((FOLLOWS[q], c + 2 + extra, a + "R", (*o, f"{NAMES[FOLLOWS[q]]}:{text}")))
            for to, *value in steps:
                if to not in new or tuple(value) < new[to]:
                    new[to] = tuple(value)
        best = new
    return min(v for q, v in grown(best).items() if q in ("", "a"))


def everything(rows):
    """All edit lists, without a graph: least (cost, audit, lines)."""
    done = []

    def go(k, q, c, a, o, inserted):
        if k == len(rows) and q in ("", "a"):
            done.append((c, a, o))
        if inserted < 2:
            to = FOLLOWS[q]
            go(k, to, c + 2, a + "I", (*o, NAMES[to] + ":"), inserted + 1)
        if k < len(rows):
            role, text, fault = rows[k]
            go(k + 1, q, c + 3, a + "D", o, 0)
            if fault in (None, "truncated"):
                extra = fault is not None
                if role[:1] == FOLLOWS[q] or (q == "" and role[:1] == "s"):
                    go(k + 1, role[:1], c + extra, a + "K", (*o, f"{role}:{text}"), 0)
                go(k + 1, FOLLOWS[q], c + 2 + extra, a + "R", (*o, f"{NAMES[FOLLOWS[q]]}:{text}"), 0)

    go(0, "", 0, "", (), 0)
    return min(done)


def want(conv, rows, find):
    marked, gaps = faults(rows)
    cost, audit, lines = find(marked) if marked else (0, "", ())
    count = lambda f: sum(x[2] == f for x in marked)
    pairs = [a[0][:1] + b[0][:1] for a, b in zip(marked, marked[1:])]
    return (conv, gaps, count("blank"), count("duplicate"), count("truncated"), sum(p not in ("su", "ua", "au") for p in pairs),
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(), len(lines))


def got(spark, table):
    rows = spark.createDataFrame([(c, t, r, x, n, "x", 1) for c, t, r, x, n in table], SCHEMA)
    repairs = repair_conversations(rows, copies="copies")
    out = sorted(map(tuple, repairs.collect()), key=str)
    lines = {}
    for r in sorted(repaired_turns(rows, repairs, copies="copies").collect(), key=lambda r: r.place):
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for r in out:  # the turns are those of the digest
        assert hashlib.sha256("\n".join(lines.get(r[0], [])).encode()).hexdigest() == r[8] and len(lines.get(r[0], [])) == r[9]
    return out


def test_short_conversations_against_all_edit_lists(spark):
    rng = random.Random(5)
    table = []
    for conv in range(60):
        for turn in range(rng.randrange(1, 5)):
            table.append((conv, rng.choice([turn, turn, 1, None]), rng.choice(ROLES), rng.choice(TEXTS), rng.choice([0, 1, 1, 1, 2])))
    by = {}
    for c, t, r, x, n in table:
        by.setdefault(c, []).extend([(t, r, x)] * n)
    assert got(spark, table) == sorted((want(c, rows, everything) for c, rows in by.items()), key=str)


@pytest.mark.parametrize("roles", [ROLES, ["user"], ["user", "assistant"], ["tool"], ["system", "user"]])
def test_long_conversations_against_string_search(spark, roles):
    """Far longer than the digits of a weight, with runs that keep several paths alive."""
    rng = random.Random(len(roles))
    table = []
    for conv in range(6):
        odd = rng.random()
        for turn in range(rng.randrange(3 * WIDTH, 20 * WIDTH)):
            role = rng.choice(roles) if rng.random() < odd else ["user", "assistant"][turn % 2]
            table.append((conv, turn, role, rng.choice([f"t{turn}.", f"t{turn}", "same.", ""]), 1))
    by = {}
    for c, t, r, x, n in table:
        by.setdefault(c, []).append((t, r, x))
    assert got(spark, table) == sorted((want(c, rows, lambda m: search(m, 2)) for c, rows in by.items()), key=str)


def test_odd_rows(spark):
    long = "w " * 300_000
    table = [(None, None, None, None, 1), (None, 3, "user", "Hi.", 1), (None, 3, "user", "Hi.", 1), (1, 5, "user", "x", 0),
             (2, 9, "user", long + "end.", 1), (2, 12, "assistant", long, 1), (3, None, "user", "a.", 1), (3, None, "assistant", "b.", 1)]
    by = {}
    for c, t, r, x, n in table:
        by.setdefault(c, []).extend([(t, r, x)] * n)
    assert got(spark, table) == sorted((want(c, rows, everything) for c, rows in by.items()), key=str)
    assert got(spark, [r for r in table if r[0] == 1]) == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest(), 0)]
    assert got(spark, []) == []


def test_damage(spark):
    rows = [(c, t, ["user", None][c % 2], ["A. b!", None, "c?"][t % 3]) for c in range(30) for t in range(8)] + [(None, None, "system", "x.")]
    out = damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    for (c, t, role, text), r in zip(rows, out):
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", " " if text is None else text
        assert r.copies == {0: 0, 3: 2}.get(kind, 1)
        assert r.role == ("user" if kind == 4 else role)
        assert r.text == ("" if kind == 1 else text.translate(dict.fromkeys(map(ord, ".!?"))) if kind == 2 else text)


def test_one_conversation_over_many_batches(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        table = [(c, t, ["user", "assistant"][t % 2], f"{t}.", 1) for c in range(3) for t in range(40)]
        assert [(r[6], r[7]) for r in got(spark, table)] == [(0, "K" * 40)] * 3
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
