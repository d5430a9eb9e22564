"""Conversation structure repair by an integer-minimum path.

A conversation is a sequence of turns.  Its repair is the cheapest list of edits
(K keep, R change the role, D delete, I insert an empty turn) after which the role
initials read ``(s?(ua)+)?``.  The graph of choices has one node for each turn and
state of that pattern (nothing yet, after s, after u, after a).  A path's weight is
one integer: its cost in the high digits, and below them ``WIDTH`` digits to base
five that spell its edits from the top, zeros after the last one.  The smaller
integer is thus the cheaper path and, at equal cost, the one whose edits come first
in ASCII order; a plain minimum at each node decides everything.

Why a minimum over prefixes is right: two paths to one node have read the same
turns, so neither's edits are a prefix of the other's unless it has two inserts
more, which cost 4 more and lead nowhere new.  One insert before a kept or changed
turn therefore suffices, and two at the end.  A node that costs more than another
one plus the price of doing its work from there (``_REACH``) is left out.

The digits stay few however long a conversation is: when they are used up, the
paths' order is all that later comparisons need, so one digit with each path's rank
takes their place and the letters move to the path's log.  Turns stream through in
order, sorted by Spark; a task holds the current turn, four paths and their logs,
never a conversation's texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\x0c\r"
ENDS = ".!?"
START, SYSTEM, USER, ASSISTANT = range(4)
NAMES = {USER: "user", ASSISTANT: "assistant"}
FOLLOWS = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
READS = {(START, "s"): SYSTEM} | {(q, NAMES[n][0]): n for q, n in FOLLOWS.items()}
LETTERS = "DIKR"  # in ASCII order: digits 1 to 4, 0 is the padding
BASE = len(LETTERS) + 1
WIDTH = 32
INSERT, REROLE, DELETE, TRUNCATED = 2, 2, 3, 1

# What a path in the second state pays at most to end like a path in the first.
_REACH = {
    (START, USER): 5, (START, ASSISTANT): 3, (SYSTEM, START): 0, (SYSTEM, USER): 2, (SYSTEM, ASSISTANT): 0,
    (USER, START): 2, (USER, SYSTEM): 2, (USER, ASSISTANT): 2, (ASSISTANT, START): 0, (ASSISTANT, SYSTEM): 4, (ASSISTANT, USER): 2,
}

_TOP = BASE**WIDTH
_PLACE = [BASE ** (WIDTH - 1 - k) for k in range(WIDTH)]

SCHEMA = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string, n_turns long"
)


def _letter(weight: int, at: int, letter: str, cost: int) -> int:
    """The weight of a path with one more edit in digit ``at``."""
    return weight + cost * _TOP + (LETTERS.index(letter) + 1) * _PLACE[at]


class _Path:
    """A path to a node: weight, digits in use, log of letters moved out, digest of the turns."""

    __slots__ = ("weight", "at", "ranked", "log", "digest", "turns")

    def __init__(self, weight, at, ranked, log, digest, turns):
        self.weight, self.at, self.ranked, self.log, self.digest, self.turns = weight, at, ranked, log, digest, turns

    def letters(self) -> str:
        digits = [self.weight % _TOP // p % BASE for p in _PLACE[: self.at]]
        return "".join(LETTERS[d - 1] for d in digits[self.ranked :])

    def with_turns(self, weight: int, at: int, turns: list[tuple[str, str]]) -> _Path:
        digest, n = self.digest, self.turns
        if turns:
            digest = digest.copy()
            for role, text in turns:
                digest.update((("\n" if n else "") + role + ":" + text).encode())
                n += 1
        return _Path(weight, at, self.ranked, self.log, digest, n)


class _Repair:
    """The cheapest paths of one conversation after the turns read so far."""

    def __init__(self):
        self.paths = {START: _Path(0, 0, 0, None, hashlib.sha256(), 0)}

    def read(self, role: str, text: str, forced: bool, truncated: bool) -> None:
        best: dict[int, tuple] = {}

        def offer(state: int, weight: int, path: _Path, at: int, turns: list) -> None:
            if state not in best or weight < best[state][0]:
                best[state] = (weight, path, at, turns)

        for state, path in self.paths.items():
            offer(state, _letter(path.weight, path.at, "D", DELETE), path, path.at + 1, [])
            if forced:
                continue
            initial, extra = role[:1], TRUNCATED if truncated else 0
            inserted = FOLLOWS[state]
            for at_state, weight, at, before in (
                (state, path.weight, path.at, []),
                (inserted, _letter(path.weight, path.at, "I", INSERT), path.at + 1, [(NAMES[inserted], "")]),
            ):
                if (after := READS.get((at_state, initial))) is not None:
                    offer(after, _letter(weight, at, "K", extra), path, at + 1, [*before, (role, text)])
                after = FOLLOWS[at_state]
                offer(after, _letter(weight, at, "R", REROLE + extra), path, at + 1, [*before, (NAMES[after], text)])
        cost = {q: w // _TOP for q, (w, *_) in best.items()}
        kept = [q for q in best if all(cost[q] <= cost[r] + _REACH.get((q, r), 99) for r in best if r != q)]
        self.paths = {q: best[q][1].with_turns(best[q][0], best[q][2], best[q][3]) for q in kept}
        if max(p.at for p in self.paths.values()) > WIDTH - 4:
            self._rank()

    def _rank(self) -> None:
        """One digit, the rank of a path's letters, takes the place of all digits."""
        low = {q: p.weight % _TOP for q, p in self.paths.items()}
        order = {x: k + 1 for k, x in enumerate(sorted(set(low.values())))}
        for q, p in self.paths.items():
            p.log = (p.log, p.letters())
            p.weight = p.weight // _TOP * _TOP + order[low[q]] * _PLACE[0]
            p.at, p.ranked = 1, 1

    def end(self) -> tuple[int, str, int, str]:
        """Cost, audit, number of turns and digest of the cheapest legal path."""
        best = None
        for state, path in self.paths.items():
            weight, at, turns = path.weight, path.at, []
            while state not in (START, ASSISTANT):
                state = FOLLOWS[state]
                weight, at, turns = _letter(weight, at, "I", INSERT), at + 1, [*turns, (NAMES[state], "")]
            if best is None or weight < best.weight:
                best = path.with_turns(weight, at, turns)
        parts, log = [best.letters()], best.log
        while log:
            log, part = log
            parts.append(part)
        return best.weight // _TOP, "".join(reversed(parts)), best.turns, best.digest.hexdigest()


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation from its turns in order; a conversation may span batches."""
    out: list[tuple] = []
    conv, one, low = None, None, None
    names = [field.split()[0] for field in SCHEMA.split(", ")]
    types = [pa.string() if field.endswith("string") else pa.int64() for field in SCHEMA.split(", ")]

    def finished() -> tuple:
        cost, audit, turns, digest = one.end()
        gaps = high - low + 1 - distinct if low is not None else 0
        return conv, gaps, *faults, illegal, cost, audit, digest, turns

    def flushed() -> pa.RecordBatch:
        columns = zip(*out)
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names)

    for batch in batches:
        for own, turn, role, text, present, repeated, blank, cut in zip(*(c.to_pylist() for c in batch.columns)):
            if one is None or own != conv:
                if one is not None:
                    out.append(finished())
                conv, one, faults, illegal, before = own, _Repair(), [0, 0, 0], 0, None
                low = high = None
                distinct, last = 0, None
            if not present:
                continue
            if turn is not None and turn != high:
                low, high, distinct = turn if low is None else low, turn, distinct + 1
            repeated = repeated or last == (turn, role, text)
            fault = 0 if blank else 1 if repeated else 2 if cut else None
            if fault is not None:
                faults[fault] += 1
            illegal += before is not None and before + role[:1] not in ("su", "ua", "au")
            before, last = role[:1], (turn, role, text)
            one.read(role, text, fault in (0, 1), fault == 2)
        if out:
            yield flushed()
            out = []
    if one is not None:
        out.append(finished())
        yield flushed()


def _turns(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, copies: str | Column | None) -> DataFrame:
    """conv, turn, role, text and copies; a null role or text is one space."""
    return turns.select(
        F.col(conv_col).cast("long").alias("conv"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col), F.lit(" ")).alias("text"),
        (F.lit(1) if copies is None else F.col(copies) if isinstance(copies, str) else copies).cast("int").alias("copies"),
    )


def repair_conversations(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    copies: str | Column | None = None,
) -> DataFrame:
    """The cheapest repair of each conversation: one row per distinct conv_id.

    Returns conv_id, gaps (missing turn numbers between the first and the last), blank,
    duplicate, truncated (turns whose first fault that is: no character but white space;
    role and text of an earlier turn; last character that is no white space not one of
    ``.!?``), illegal (neighbours whose initials aren't su, ua or au), cost, audit (the
    edits' letters in order), repaired_sha256 (``role:text`` of the repaired turns, joined by
    newlines, UTF-8) and n_turns (after repair).  :func:`repaired_turns` gives the turns.

    Costs: keep 0, change the role to user or assistant 2, delete 3 (blank and duplicate
    turns must go), insert an empty turn of user or assistant 2; a truncated turn that stays 1.
    Turns come in order of turn number, nulls first, then role and text by code point; a
    null role or text is one space, so such a text is blank.  Rows with a null conv_id are one
    conversation.  ``copies`` says how often each row stands (0: it is gone, but its
    conversation still comes back, with zeros, an empty audit and the hash of nothing).
    Other columns, whatever their names, are ignored; an empty table gives none.

    A conversation may hold a large part of all rows: repeats are found by an aggregate
    that combines before its shuffle, and the turns pass through one task as a sorted
    stream, since the digest reads them one after the other.
    """
    rows = _turns(turns, conv_col, turn_col, role_col, text_col, copies)
    rows = rows.withColumn("place", F.struct(F.col("turn").isNotNull(), F.coalesce("turn", F.lit(0))))
    rows = rows.withColumn("mark", F.md5(F.concat(F.md5("role"), "text")))
    twice = (
        rows.where("copies > 0").groupBy("conv", "mark")
        .agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
        .select(F.col("conv").alias("of"), F.col("mark").alias("again"), "first")
    )
    rows = rows.join(twice, F.col("conv").eqNullSafe(F.col("of")) & (F.col("mark") == F.col("again")), "left")
    ordered = (
        rows.select(
            "conv", "turn", "role", "text", (F.col("copies") > 0).alias("present"),
            F.coalesce(F.col("place") > F.col("first"), F.lit(False)).alias("repeated"),
            F.rtrim("text", F.lit(WHITE)).alias("trimmed"),
            F.explode(F.sequence(F.lit(1), F.greatest("copies", F.lit(1)))).alias("copy"),
        )
        .select(
            "conv", "turn", "role", "text", "present", "repeated",
            (F.col("trimmed") == "").alias("blank"), (~F.substring("trimmed", -1, 1).isin(*ENDS)).alias("cut"),
        )
        .repartition("conv")
        .sortWithinPartitions(F.asc_nulls_first("conv"), F.asc_nulls_first("turn"), "role", "text")
    )
    return ordered.mapInArrow(_stream, SCHEMA)


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The repaired turns, one by one, of conversations that start with their edits."""
    out: list[tuple] = []
    conv, state, place, edits = None, START, 0, iter("")

    def inserts() -> str | None:
        """Emits the inserts that come next; the first other edit, or none."""
        nonlocal state, place
        for edit in edits:
            if edit != "I":
                return edit
            state, place = FOLLOWS[state], place + 1
            out.append((conv, place, None, "I", NAMES[state], ""))
        return None

    def flushed() -> pa.RecordBatch:
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), types)], [f.split()[0] for f in TURNS.split(", ")])

    for batch in batches:
        for own, turn, role, text, plan in zip(*(c.to_pylist() for c in batch.columns)):
            if plan is not None:
                inserts()  # what the conversation before has at its end
                conv, state, place, edits = own, START, 0, iter(plan)
                continue
            edit = inserts()
            if edit == "D":
                continue
            if edit == "R":
                state = FOLLOWS[state]
                role = NAMES[state]
            else:
                state = READS[state, role[:1]]
            place += 1
            out.append((conv, place, turn, edit, role, text))
        if out:
            yield flushed()
            out = []
    inserts()
    if out:
        yield flushed()


TURNS = "conv_id long, place long, turn long, edit string, role string, text string"


def repaired_turns(
    turns: DataFrame,
    repairs: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    copies: str | Column | None = None,
) -> DataFrame:
    """The turns that :func:`repair_conversations` leaves, given its result: conv_id, place
    (from 1), turn (null where inserted), edit (K, R or I), role and text.

    Each conversation's edits are sorted before its turns, and one stream applies them.
    """
    rows = _turns(turns, conv_col, turn_col, role_col, text_col, copies).where("copies > 0")
    rows = rows.select("conv", "turn", "role", "text", F.explode(F.sequence(F.lit(1), "copies")).alias("copy"), F.lit(None).cast("string").alias("plan"))
    plans = repairs.select(
        F.col("conv_id").alias("conv"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"),
        F.lit(0).alias("copy"), F.col("audit").alias("plan"),
    )
    ordered = rows.union(plans).repartition("conv").sortWithinPartitions(
        F.asc_nulls_first("conv"), F.desc_nulls_last("plan"), F.asc_nulls_first("turn"), "role", "text"
    )
    return ordered.select("conv", "turn", "role", "text", "plan").mapInArrow(_edited, TURNS)


def damaged(turns: DataFrame) -> DataFrame:
    """``conversations`` with known damage, and a column ``copies`` (0: dropped).

    By crc32 of ``conv_id:turn`` (a null is one space) modulo 20: 0 drops a row, 1 empties
    its text, 2 removes its ``.!?``, 3 repeats it, 4 makes its role user.  A null role or
    text becomes one space first.
    """
    name = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" "))
    )
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    kind = F.col("kind")
    return turns.select("conv_id", "turn", "role", "text", (F.crc32(name.cast("binary")) % 20).alias("kind")).select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ENDS, "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )
