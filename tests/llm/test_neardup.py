"""Near-duplicates, shingle hashes and components against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tallyhouse.llm import components as contraction
from tallyhouse.llm import neardup, words
from tallyhouse.llm.components import connected_components

SCHEMA = "doc_id long, text string, component_id long, digest string, bands string, n_chars long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(found) < 5:
        return {tuple(found)} if found else set()
    return {tuple(found[k : k + 5]) for k in range(len(found) - 4)}


def components(rows):
    """Smallest reachable doc_id by document, comparing all pairs."""
    sets = {}
    for doc_id, text in rows:
        if doc_id is not None:
            sets.setdefault(doc_id, []).append(shingle_set(text))
    smallest = {d: d for d in sets}

    def similar(a, b):
        return a and b and 100 * len(a & b) >= 75 * len(a | b)

    changed = True
    links = [(a, b) for a in sets for b in sets if a < b and any(similar(x, y) for x in sets[a] for y in sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(smallest[a], smallest[b])
            changed |= smallest[a] != low or smallest[b] != low
            smallest[a] = smallest[b] = low
    return smallest


def run(spark, rows):
    table = spark.createDataFrame([(d, t, 7, "x", "y", 1) for d, t in rows], SCHEMA)
    return [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(table).collect()]


def edited_copies():
    draw = random.Random(5)
    vocabulary = [f"w{i}é" for i in range(400)]
    rows, doc_id = [], 100
    for group in range(6):
        base = draw.choices(vocabulary, k=draw.randint(5, 160))
        for _ in range(draw.randint(1, 14)):
            own = list(base)
            for _ in range(draw.randint(0, 6)):
                own[draw.randrange(len(own))] = draw.choice(vocabulary)
            doc_id += draw.choice((-3, 7))
            rows.append((doc_id * 10 + group, " ".join(own)))
    base = draw.choices(vocabulary, k=90)
    for i in range(60):  # one crowded group, edited by up to a third
        own = list(base)
        for _ in range(draw.randint(0, 8)):
            own[draw.randrange(len(own))] = draw.choice((f"own{i}", draw.choice(vocabulary)))
        rows.append((90_000 + i, " ".join(own)))
    return rows


def chain():
    """Each text is like the next one only; the chain is one group."""
    return [(50_000 - i, " ".join(f"c{k}" for k in range(8 * i, 8 * i + 80))) for i in range(40)]


def odd_rows():
    long = " ".join(f"x{i % 977}" for i in range(60_000))
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "One  TWO"), (6, "one two three"), (None, "one two"),
        (7, "a b c d e"), (8, "a b c d e"), (8, "a b c d e"), (9, long), (10, long + " end"), (11, "A b c d e"),
        (12, "only here six words are said"), (12, "a b c d e"), (13, "only here six words are said"),
    ]


def test_groups_match_brute_force(spark):
    rows = edited_copies() + chain() + odd_rows()
    expected = components(rows)
    want = sorted(((d, len(shingle_set(t)), expected.get(d), d is None or expected[d] == d) for d, t in rows), key=repr)
    got = run(spark, rows)
    assert sorted(got, key=repr) == want
    assert len({r[2] for r in got if r[0] and 49_900 < r[0] <= 50_000}) == 1


def test_empty_table(spark):
    assert run(spark, []) == []


def test_one_of_each_group_keeps_columns(spark):
    text = " ".join(f"w{i}" for i in range(30))
    table = spark.createDataFrame([(3, text, 9, "d", "b", 1), (2, text, 9, "d", "b", 1), (5, None, 9, None, None, None)], SCHEMA)
    kept = neardup.one_of_each_group(table)
    assert kept.columns == table.columns and sorted(r.doc_id for r in kept.collect()) == [2, 5]


def test_shingles_do_not_depend_on_chunks(monkeypatch):
    draw = random.Random(1)
    texts = [" ".join(draw.choices("a bb ccc É".split(), k=draw.randint(0, 40))) for _ in range(60)] + [None, ""]

    def sets():
        out = []
        for chunk in words.chunks(pa.array(texts, pa.string())):
            hashes, begin = words.distinct_sets(*words.shingles(chunk.words, chunk.at))
            out += [tuple(hashes[a:b]) for a, b in zip(begin[:-1], begin[1:], strict=True)]
        return out

    whole = sets()
    assert [len(s) for s in whole] == [len(shingle_set(t)) for t in texts]
    monkeypatch.setattr(words, "CHUNK_BYTES", 37)
    assert sets() == whole


def test_min_max_values_estimate_similarity():
    draw = np.random.default_rng(3)
    common, a, b = (draw.integers(0, 2**63, n, dtype=np.uint64) for n in (600, 200, 200))
    values = neardup.min_max_values(np.concatenate((common, a, common, b)), np.array([0, 800, 1600]))
    assert (values[0] == values[1]).mean() == pytest.approx(0.6, abs=0.1)


def test_components_of_random_graphs(spark):
    draw = random.Random(1)
    edges = [(draw.randrange(120), draw.randrange(120)) for _ in range(80)] + [(7, 7), (3, None)]
    edges += [(500, 500 + i) for i in range(1, 60)] + [(700 + i, 701 + i) for i in range(50)]
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {}
    for a, b in edges:
        if b is not None and a != b:
            want.setdefault(a, a), want.setdefault(b, b)
    for _ in range(200):
        for a, b in edges:
            if a in want and b in want:
                want[a] = want[b] = min(want[a], want[b])
    assert found == want


def staged_by(module, monkeypatch):
    """The names of the tables that this module writes from now on."""
    names, write = [], module.stage
    monkeypatch.setattr(module, "stage", lambda df, name: names.append(name) or write(df, name))
    return names


def test_one_round_of_components_writes_no_more_than_it_has_to(spark, monkeypatch):
    written = staged_by(contraction, monkeypatch)
    star = spark.createDataFrame([(0, i) for i in range(1, 30)], "a long, b long")
    assert {(r.node, r.component) for r in connected_components(star).collect()} == {(i, 0) for i in range(30)}
    assert written == ["edges", "nearest", "points", "edges"]


def test_what_is_joined_goes_on_as_one_link_a_document(spark, monkeypatch):
    """The chain of 40 takes rounds once; the second search finds it contracted."""
    searched, search = [], neardup.connected_components
    monkeypatch.setattr(neardup, "connected_components", lambda edges: searched.append(edges.where("a <> b").distinct().collect()) or search(edges))
    assert {r[2] for r in run(spark, chain())} == {49_961}
    assert len(searched) == 2 and {r.b for r in searched[1]} == {49_961}


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "a string, b string")).collect() == []


def test_small_sets_lose_no_link(spark):
    """A text of 7 words inside one of 8 has 3 of 4 shingles: exactly 75 percent, 2,000 times."""
    rows = []
    for i in range(2000):
        words = [f"w{i}x{k}" for k in range(8)]
        rows += [(2 * i, " ".join(words[:7])), (2 * i + 1, " ".join(words))]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r.component_id == r.doc_id - r.doc_id % 2 for r in got)


def test_similar_small_sets_share_a_prefix():
    """All sizes of 1 to 20 shingles, with every partner that reaches the similarity."""
    draw = np.random.default_rng(4)
    for n in range(1, neardup.SMALL + 1):
        for m in range(n, neardup.MEETS_SMALL + 1):
            most = n
            least = -(-75 * (n + m) // 175)
            for shared in range(least, most + 1):
                if 100 * shared < 75 * (n + m - shared):
                    continue
                for _ in range(8):
                    pool = draw.integers(0, 2**63, n + m - shared, dtype=np.uint64)
                    a, b = np.sort(pool[:n]), np.sort(pool[n - shared :])
                    assert set(neardup.prefix_keys(a).tolist()) & set(neardup.prefix_keys(b).tolist())


def test_rows_that_repeat_leave_one(spark):
    text = "one two three four five six seven"
    rows = [(1, text, "a"), (1, text, "a"), (2, text, "b"), (None, "loose", "c"), (None, "loose", "c"), (None, None, "d"), (None, None, "d"), (3, "x", "e"), (3, "y", "e"), (4, None, "f")]
    left = neardup.one_of_each_group(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert left.columns == ["doc_id", "text", "source"]
    key = lambda r: (str(r[0]), str(r[1]))
    assert sorted((tuple(r) for r in left.collect()), key=key) == sorted([(1, text, "a"), (None, "loose", "c"), (None, None, "d"), (3, "x", "e"), (3, "y", "e"), (4, None, "f")], key=key)
