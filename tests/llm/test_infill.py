"""Fill-in-middle: the skip list against prefix sums, the operator against a plain version, round trips."""

from __future__ import annotations

import hashlib
import random
import re

from pyspark.sql import functions as F

from tallyhouse.llm import infill

SCHEMA = "doc_id long, text string, n long, form string, output string"


def plain_version(doc_id: int | None, text: str | None) -> tuple:
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, _, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return doc_id, len(units), "plain", None, None, text
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h4 % 100 < 50 else "psm"
    return doc_id, len(units), form, len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"


def test_skip_list_reaches_every_rank():
    draw = random.Random(3)
    for n in (0, 1, 2, 3, 17, 64, 1000):
        widths = [draw.randint(1, 90) for _ in range(n)]
        lines = infill.SkipList(widths)
        assert [lines.place(r) for r in range(n + 1)] == [sum(widths[:r]) for r in range(n + 1)]


def test_skip_list_descends_in_few_steps():
    lines = infill.SkipList([1] * 200_000)
    assert 6 <= len(lines.lanes) <= 16
    assert len(lines.lanes[-1][0]) < 100
    assert max(max(b) for b, _, _ in lines.lanes[:3]) < 2_000  # no link of a low lane passes over much


def test_units():
    for text in ("", "\n", "a", "a\n", "\n\n", "a\nb", "\r\n\x0bé x\n😀", "\n\na"):
        assert infill.unit_widths(text) == [len(x) for x in re.findall(r"[^\n]*\n|[^\n]+", text)]


def test_against_plain_version(spark):
    draw = random.Random(11)
    pieces = ["\n", "\r\n", "é", "😀😀", "word ", "<", "<P", ">", "S>", "<M", "&", " ", " "]
    rows = [(i, "".join(draw.choice(pieces) for _ in range(draw.randint(0, 40)))) for i in range(300)]
    rows += [(-5, None), (None, "a\nb\nc"), (None, None), (7, ""), (7, "\n"), (8, "x <S> y\nz"), (9, "long\n" * 30_000), (10, "w" * 200_000)]
    rows += [(11, "same\nrow"), (11, "same\nrow")]
    made = infill.fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string"))
    key = lambda r: (r[0] is None, r[0] or 0, r[5])
    assert sorted((tuple(r) for r in made.collect()), key=key) == sorted((plain_version(*r) for r in rows), key=key)
    back = made.select(infill.restored(F.col("output"), F.col("form")).alias("text"))
    assert sorted(r.text for r in back.collect()) == sorted(t or "" for _, t in rows)


def test_rates(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("a\nb\nc\n").alias("text"))
    forms = {r["form"]: r["count"] for r in infill.fill_in_middle(docs, rate=30, suffix_first=0).groupBy("form").count().collect()}
    assert set(forms) == {"plain", "psm"} and 80 < forms["psm"] < 160


def test_clashing_columns_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a\nb", 5, "x", "y", 2)], "doc_id long, text string, n int, form string, output string, h1 int")
    (row,) = infill.infill_report(docs).collect()
    assert row.n == 2 and row.restored_sha256 == hashlib.sha256(b"a\nb").hexdigest()
    assert infill.infill_report(spark.createDataFrame([], SCHEMA)).collect() == []
