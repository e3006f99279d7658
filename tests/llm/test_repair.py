"""Conversation repair against all edits by brute force, and against a plain version of its contract."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest

from tallyhouse.llm import repair

ROWS = "conv_id long, turn long, role string, text string, lost string, fault string, said int"
BLANKS = " \t\n\x0b\x0c\r"


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        core = text.rstrip(BLANKS)
        if not core:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if core[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def every_audit(rows, told, most=2):
    """(cost, audit, repaired) of all edits with at most ``most`` inserts at any place."""
    choices = []
    for (_, role, text), fault in zip(rows, told, strict=True):
        must, extra = fault in ("blank", "duplicate"), 5 * (fault == "truncated")
        own = [(2, "D", [])]
        if not must:
            own.append((extra, "K", [(role, text)]))
            own += [(1 + extra, "R", [(r, text)]) for r in ("user", "assistant")]
        choices.append(own)
    fills = [list(itertools.product(("user", "assistant"), repeat=k)) for k in range(most + 1)]
    fills = [(5 * k, "I" * k, [(r, "") for r in roles]) for k, f in enumerate(fills) for roles in f]
    slots = [fills]
    for own in choices:
        slots += [own, fills]
    for way in itertools.product(*slots):
        left = [x for _, _, said in way for x in said]
        if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "-" for r, _ in left)):
            yield sum(c for c, _, _ in way), "".join(e for _, e, _ in way), "\n".join(f"{r}:{t}" for r, t in left)


def quick_audit(rows, told):
    """The same by a table over (row, state), from the end, taking the least letter first."""
    after = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    names = {"u": "user", "a": "assistant"}
    inf = float("inf")
    best = [dict.fromkeys(after, inf) for _ in range(len(rows) + 1)]

    def moves(i, state):
        to = "a" if state == "u" else "u"
        yield "I", 5, i, to, (names[to], "")
        if i < len(rows):
            _, role, text = rows[i]
            extra = 5 * (told[i] == "truncated")
            yield "D", 2, i + 1, state, None
            if told[i] in ("", "truncated"):
                yield "R", 1 + extra, i + 1, to, (names[to], text)
                if role[:1] in after[state]:
                    yield "K", extra, i + 1, after[state][role[:1]], (role, text)

    for i in range(len(rows), -1, -1):
        if i == len(rows):
            best[i][""] = best[i]["a"] = 0
        for _ in range(4):
            for state in after:
                best[i][state] = min([best[i][state], *(c + best[j][t] for _, c, j, t, _ in moves(i, state))])
    i, state, audit, said = 0, "", "", []
    while not (i == len(rows) and best[i][state] == 0):
        e, _, i, state, made = min(m for m in moves(i, state) if m[1] + best[m[2]][m[3]] == best[i][state])
        audit, said = audit + e, said + ([made] if made else [])
    return best[0][""], audit, "\n".join(f"{r}:{t}" for r, t in said)


def expected(rows):
    """rows: (turn, role, text) of one conversation."""
    rows = sorted(((t, r or "", x or "") for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    told = faults(rows)
    turns = {t for t, _, _ in rows if t is not None}
    initials = [r[:1] for _, r, _ in rows]
    cost, audit, repaired = quick_audit(rows, told)
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0, told.count("blank"), told.count("duplicate"), told.count("truncated"),
        sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)), cost, audit, hashlib.sha256(repaired.encode()).hexdigest(),
    )


def random_rows(draw, n, roles=("system", "user", "assistant", "user", "assistant", "tool", "")):
    texts = ["Yes.", "No!", "cut", "", " \t", "Why? ", "a.b", "é…", "ok."]
    return [(draw.choice([None, *range(12)]), draw.choice(roles), draw.choice(texts) + (str(draw.randrange(9)) + "." if draw.random() < 0.5 else "")) for _ in range(n)]


def test_table_equals_all_edits():
    draw = random.Random(5)
    for _ in range(60):
        rows = sorted(random_rows(draw, draw.randint(0, 4)), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        told = faults(rows)
        every = list(every_audit(rows, told, 2 if len(rows) < 3 else 1))
        cost, audit, _ = min(every)
        assert len({x for x in every if x[:2] == (cost, audit)}) == 1
        assert quick_audit(rows, told) == min(every)


@pytest.mark.parametrize("spill", [16, 1 << 20])
def test_stream_equals_table(spark, spill):
    draw = random.Random(8)
    given = {i: random_rows(draw, draw.randint(0, 14)) for i in range(150)}
    given[None] = random_rows(draw, 30)
    given[2**62 + 1] = [(2**61 + 3, "user", "Hi."), (2**61 + 9, "assistant", "Ho.")]
    given[900] = [(0, "user", "x" * 300_000 + "."), (1, "assistant", "fine!")] * 2  # repeated rows, a long text
    flat = [(c, t, r or None, x or None, "l", "f", 3) for c, rows in given.items() for t, r, x in rows]
    draw.shuffle(flat)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # conversations go on over batches
    try:
        got = {r[0]: tuple(r)[1:] for r in repair.repair(spark.createDataFrame(flat, ROWS), spill_bytes=spill).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    assert got == {c: expected(rows) for c, rows in given.items() if rows}


def test_long_conversation_spills(spark):
    """20,000 rows of one conversation; pointers are read back from many blocks."""
    draw = random.Random(2)
    rows = [(i, draw.choice(("user", "assistant")), f"{i}" + draw.choice((".", "", "!", "?"))) for i in range(20_000)]
    (got,) = repair.repair(spark.createDataFrame([(1, *r) for r in rows], "conv_id long, turn long, role string, text string"), spill_bytes=1000).collect()
    assert tuple(got)[1:] == expected(rows)


def test_inserts_can_win(monkeypatch):
    """At the real prices an insert hardly ever wins; with dear deletions and changes of role it does."""
    monkeypatch.setattr(repair, "DELETE", 20)
    monkeypatch.setattr(repair, "REROLE", 30)
    monkeypatch.setattr(repair, "WAYS", {k: repair._ways(*k) for k in repair.WAYS})
    c = repair.Conversation(1)
    for i, role in enumerate(("user", "user", "assistant", "user")):
        c.add(i, role, f"{i}.", 0)
    cost, audit, digest = c.repaired()
    assert (cost, audit) == (10, "KIKKKI")
    assert digest == hashlib.sha256(b"user:0.\nassistant:\nuser:1.\nassistant:2.\nuser:3.\nassistant:").hexdigest()


def test_one_shuffle(spark):
    plan = repair.repair(spark.range(9).selectExpr("id conv_id", "id turn", "'user' role", "'x.' text"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_damage_and_dropped_conversations(spark):
    rows = [(c, t, draw, f"One. Two! {c}?") for c in range(200) for t, draw in enumerate(("user", "assistant"))]
    rows += [(c, 5, "user", "Alone.") for c in range(1000, 1060)]
    rows += [(None, 1, "user", "A."), (None, 2, "assistant", "B."), (777, None, None, None), (778, 1, "user", "")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    given = {}
    for c, t, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        own = given.setdefault(c, [])
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            own += [(t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    assert any(not r for r in given.values())  # a conversation that lost all rows
    got = {r[0]: tuple(r)[1:] for r in repair.repair(repair.damaged(table), lost="lost").collect()}
    assert got == {c: expected(r) for c, r in given.items()}


def test_empty_table(spark):
    empty = spark.createDataFrame([], ROWS)
    assert repair.repair(empty).collect() == [] and repair.repair(repair.damaged(empty), lost="lost").collect() == []
