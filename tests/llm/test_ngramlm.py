"""The n-gram trie: its sequences against sorted arrays, scores against plain counting."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tallyhouse.llm import ngramlm
from tallyhouse.llm.eliasfano import EliasFano, Level

DOCS = "doc_id long, text string, chunk string, held_out string, score int, order int"


@pytest.mark.parametrize("n, top", [(0, 1), (1, 1), (1, 2**63), (5, 5), (1000, 2**63), (5000, 6000), (3000, 10**6), (4097, 2**40)])
def test_sequence(n, top):
    draw = np.random.default_rng(n)
    values = np.sort(draw.integers(0, top, n, dtype=np.uint64))
    sequence = EliasFano(values)
    assert (sequence.access(np.arange(n)) == values).all()
    asked = np.concatenate((values, draw.integers(0, top + 1, 500, dtype=np.uint64), values + np.uint64(1)))
    place, equal = sequence.successor(asked)
    assert (place == np.searchsorted(values, asked)).all() and (equal == np.isin(asked, values)).all()


def test_level():
    draw = random.Random(4)
    pairs = Counter((draw.choice((0, 1, 7, 10**12)), draw.choice((0, 1, 2**40, draw.randrange(300)))) for _ in range(900))
    context, word = (np.array(x, np.uint64) for x in zip(*sorted(pairs), strict=True))
    counts = np.array([pairs[p] for p in sorted(pairs)])
    level = Level(context, word, counts, np.arange(len(pairs)).astype(np.uint8))
    asked = sorted({(c, w) for c in (0, 1, 2, 7, 10**12, 10**13) for w in (*range(310), 2**40, 2**40 + 1)})
    contexts, spans = np.unique([c for c, _ in asked], return_counts=True)
    place = level.find(contexts.astype(np.uint64), spans, np.array([w for _, w in asked], np.uint64))
    known = {p: i for i, p in enumerate(sorted(pairs))}
    assert place.tolist() == [known.get(p, -1) for p in asked]
    assert (level.count(np.arange(len(pairs))) == counts).all()
    # Far below the eight bytes a number that plain arrays take.
    many = np.sort(draw_ := np.random.default_rng(1).choice(10**7, 10**5, replace=False)).astype(np.uint64)
    assert EliasFano(many).nbytes < 1.4 * len(draw_)


def test_numbers_survive_packing():
    for numbers in ([], [0], [255, 256], [2**64 - 1, 0, 3], list(range(1000))):
        assert ngramlm.unpack(ngramlm.pack(np.array(numbers, np.uint64))).tolist() == numbers


def tokens(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), None]


def held(doc_id):
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 10 == 0


def plain_scores(rows, order):
    grams = [Counter() for _ in range(order + 1)]
    for doc_id, text in rows:
        if held(doc_id):
            continue
        own = [None, *tokens(text)]
        for i in range(1, len(own)):
            for k in range(1, order + 1):
                if i - k + 1 >= (1 if k == 1 else 0):
                    grams[k][tuple(own[i - k + 1 : i + 1])] += 1
    total, distinct = sum(grams[1].values()), len(grams[1])
    out = []
    for doc_id, text in rows:
        own, base, full, known = [None, *tokens(text)], 0.0, 0.0, 0
        for i in range(1, len(own)):
            c = grams[1][own[i],]
            known += c > 0
            p = (c + 0.1) / (total + 0.1 * (distinct + 1))
            base += math.log10(p)
            for k in range(2, order + 1):
                if i - k + 1 < 0:
                    continue
                context = tuple(own[i - k + 1 : i])
                of_context = grams[1][(None,)] if context == (None,) else grams[k - 1][context]
                c, share = grams[k][(*context, own[i])], 0.0
                if c:
                    share = 10 ** -((math.ceil(-math.log10(c / (of_context + ngramlm.PRIOR)) * ngramlm.STEPS - 1e-9)) / ngramlm.STEPS)
                p = share + ngramlm.PRIOR / (of_context + ngramlm.PRIOR) * p
            full += math.log10(p)
        out.append((doc_id, held(doc_id), len(own) - 1, known, total, base, full))
    return out


def corpus(draw, n=300):
    words = ["the", "The", "a", "cat", "sat", "é", "Éx", "on\x0bmat", "x" * 50, "\n", "\t", "dog.", *(f"w{i}" for i in range(60))]
    rows = [(i, " ".join(draw.choices(words, weights=range(len(words), 0, -1), k=draw.randint(0, 60)))) for i in range(n)]
    rows += [(n, None), (n + 1, ""), (n + 2, " \n "), (None, "the cat"), (None, None), (7, "again the cat"), (7, "again the cat"), (n + 3, "long words " * 30_000)]
    return rows + [(n + 10 + i, f"never{i} seen{i}") for i in range(12)]


def close(got, wanted):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    for a, b in zip(sorted((tuple(r) for r in got), key=key), sorted(wanted, key=key), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9) and a[6] == pytest.approx(b[6], rel=1e-9), (a, b)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_plain_counting(spark, order):
    rows = corpus(random.Random(order))
    docs = spark.createDataFrame([(*r, "c", "h", 1, 2) for r in rows], DOCS).repartition(3)
    # Many chunks and shards, and contexts that are split.
    close(ngramlm.scored(docs, order, chunk_tokens=900, shard_tokens=9_000, split=200).collect(), plain_scores(rows, order))


def test_chances_add_up_to_one_at_most():
    draw = np.random.default_rng(0)
    for _ in range(50):
        counts = draw.integers(1, 40, draw.integers(1, 200))
        share = ngramlm.unquantised(ngramlm.quantised(counts / (counts.sum() + ngramlm.PRIOR)))
        assert share.sum() + ngramlm.PRIOR / (counts.sum() + ngramlm.PRIOR) <= 1 + 1e-9


def test_nothing_to_learn(spark):
    alone = [i for i in range(200) if held(i)][:3]
    rows = [(i, "some words") for i in alone]
    got = ngramlm.scored(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(tuple(r) for r in got) == [(i, True, 3, 0, 0, 0.0, 0.0) for i in sorted(alone)]
    assert ngramlm.scored(spark.createDataFrame([], DOCS)).collect() == []


def test_held_out_texts_are_told_better_than_by_words_alone(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [r for r in ngramlm.scored(docs).collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)
