"""Line deduplication against brute force."""

import hashlib
import random
from collections import defaultdict

from tallyhouse.llm import linededup

SCHEMA = "doc_id long, text string, n_chars long, _kept string, h1 long, dropped string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(" \t\n\x0b\f\r").translate(LOWER)


def expected(rows):
    holders = defaultdict(set)
    for doc_id, text in rows:
        if doc_id is not None:
            for line in (text or "").split("\n"):
                if len(key(line)) >= 40:
                    holders[key(line)].add(doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        stays = [x for x in lines if doc_id is None or len(holders[key(x)]) < 5 or max(holders[key(x)]) == doc_id]
        out.append((doc_id, len(lines), len(lines) - len(stays), "\n".join(stays)))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(d, t, len(t or ""), "k", 1, "d") for d, t in rows], SCHEMA)


def check(spark, rows):
    want = [(d, n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in expected(rows)]
    got = [tuple(r) for r in linededup.line_report(frame(spark, rows)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_random_documents(spark):
    draw = random.Random(4)
    lines = [f"{'É' if i % 3 else 'x'}{i} shared line that is long enough to count " + "y" * (i % 4) for i in range(30)]
    pool = lines + [x.upper() for x in lines] + [f" \t{x}\r" for x in lines] + ["", "short", "short", "s" * 39, "S" * 40, " " + "s" * 40]
    rows = [(draw.randrange(60), "\n".join(draw.choices(pool, k=draw.randint(1, 90)))) for _ in range(70)]
    check(spark, rows)


def test_odd_rows(spark):
    line = "the same long line that very many documents have"
    rows = [(i, line) for i in range(6)] + [(None, line), (9, None), (10, ""), (11, "\n\n"), (3, line), (3, "other\n" + line)]
    rows += [(20, "\n".join([line] * 70 + ["z" * 50] + [line] * 70)), (21, "ab\n" * 5000 + line)]
    check(spark, rows)


def test_four_documents_are_too_few(spark):
    line = "l" * 40
    check(spark, [(i, f"{line}\n{line}") for i in range(4)])
    check(spark, [(i, f"{line}\n{line}") for i in range(5)])


def test_empty_table(spark):
    assert linededup.line_report(frame(spark, [])).collect() == []


def test_stage_keeps_columns_and_counts_characters(spark):
    line = "q" * 45
    table = frame(spark, [(i, f"{line}\né") for i in range(5)] + [(None, None)])
    out = linededup.without_repeated_lines(table)
    assert out.schema == table.schema
    assert sorted((r.doc_id, r.text, r.n_chars) for r in out.collect() if r.doc_id is not None) == [
        *((i, "é", 1) for i in range(4)), (4, f"{line}\né", 47)
    ]


def test_bitmaps_hold_no_text(spark):
    rows = [(i, "\n".join(["w" * 50] * 3 + ["own"])) for i in range(6)]
    found = {r.doc_id: (r.dropped, r.n_dropped) for r in linededup.keep_bitmaps(frame(spark, rows)).collect()}
    assert found == {i: ({0: 7}, 3) for i in range(5)}
