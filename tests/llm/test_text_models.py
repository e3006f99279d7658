"""Language identification, toxicity and decontamination."""

import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import decontam, langid, toxicity
from tallyhouse.llm.words import NOT_PLAIN

SMALL = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, score double, labels string, slots string"


def docs(spark, rows):
    return spark.createDataFrame([(d, t, lang, "s", 0.1, "l", "x") for d, t, lang in rows], DOCS)


def speech(draw, syllables, words):
    return " ".join("".join(draw.choices(syllables, k=draw.randint(1, 3))) for _ in range(words)).capitalize() + "."


NORTH, SOUTH = "ka ki sva jo ny tø då".split(), "lla ue ció ñe bo ra es".split()


@pytest.fixture(scope="module")
def two_tongues():
    draw = random.Random(8)
    rows = [(i, speech(draw, NORTH if i % 2 else SOUTH, draw.randint(3, 80)), "no" if i % 2 else "su") for i in range(200)]
    return rows


def test_language_of_unseen_documents(spark, two_tongues):
    got = {r.doc_id: r for r in langid.identify(docs(spark, two_tongues)).collect()}
    truth = {d: lang for d, _, lang in two_tongues}
    unseen = [r for r in got.values() if r.held_out]
    assert unseen and all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) for d, r in got.items())
    assert sum(r.lang_pred == truth[r.doc_id] for r in unseen) >= 0.97 * len(unseen)
    assert not any(r.rejected for r in got.values())
    assert all(0 <= r.score <= 1 for r in got.values())


def test_held_out_labels_are_never_read(spark, two_tongues):
    def judged(rows):
        return sorted((r.doc_id, r.lang_pred, r.score) for r in langid.identify(docs(spark, rows)).collect())

    hidden = [(d, t, "zz" if zlib.crc32(str(d).encode()) % 4 == 2 else lang) for d, t, lang in two_tongues]
    assert judged(hidden) == judged(two_tongues)


def test_language_of_odd_texts(spark, two_tongues):
    odd = [(1000, None, "no"), (1001, "", "no"), (1002, "12 ... !!", None), (None, "kasva jony", "zz"), (1003, "ka " * 90_000, None), (7, two_tongues[7][1], "no")]
    got = [r for r in langid.identify(docs(spark, two_tongues + odd)).collect()]
    by_id = {r.doc_id: r for r in got}
    assert len(got) == len(two_tongues) + len(odd)
    assert [by_id[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3
    assert all(by_id[i].rejected and by_id[i].score == 0 for i in (1000, 1001, 1002))
    assert by_id[1003].lang_pred == "no" and not by_id[1003].held_out | (zlib.crc32(b"1003") % 4 == 2)
    assert by_id[None].lang_pred == "no" and by_id[None].held_out is False


def test_language_without_anything_to_learn(spark):
    assert langid.identify(docs(spark, [])).collect() == []
    got = langid.identify(docs(spark, [(1, "some words", None)])).collect()
    assert [(r.lang_pred, r.score, r.rejected) for r in got] == [("und", 0.0, True)]


def test_rejected_documents_go(spark, two_tongues):
    foreign = [(2000, "日本語の文章です。これは別の言語です。" * 9, None), (2001, "?!", "no")]
    table = docs(spark, two_tongues + foreign)
    kept = langid.identified_only(table)
    assert kept.schema == table.schema
    assert {r.doc_id for r in kept.collect()} == {d for d, *_ in two_tongues}


def test_language_accuracy_on_the_test_tables(spark):
    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    judged = langid.identify(table).join(table.select("doc_id", "lang"), "doc_id").where("held_out")
    assert judged.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] >= 0.97


def labelled(rows):
    return [(d, 1, int(toxic)) for d, toxic in rows]


LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def quarrel():
    draw = random.Random(3)
    rows = []
    for i in range(400):
        said = [speech(draw, NORTH, 1) for _ in range(draw.randint(5, 90))]
        if i % 5 == 0:
            for _ in range(draw.randint(2, 6)):
                said.insert(draw.randrange(len(said)), draw.choice(("Blockhead", "numskull,", "dolt")))
        rows.append((i, " ".join(said), i % 5 == 0))
    return rows


def test_toxic_documents_are_told_apart(spark, quarrel):
    table = docs(spark, [(d, t, None) for d, t, _ in quarrel])
    labels = spark.createDataFrame(labelled((d, x) for d, _, x in quarrel), LABELS)
    got = {r.doc_id: r for r in toxicity.toxicity(table, labels).collect()}
    truth = {d: int(x) for d, _, x in quarrel}
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in got.items())
    unseen = [r for r in got.values() if r.held_out]
    assert sum(r.predicted == truth[r.doc_id] for r in unseen) >= 0.97 * len(unseen)
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in got.values())
    toxic = next(r for r in unseen if truth[r.doc_id])
    assert toxic.evidence and sum(truth[e] for e in toxic.evidence) > len(toxic.evidence) / 2


def test_toxicity_of_odd_texts(spark, quarrel):
    odd = [(1000, None), (1001, ""), (1002, "..."), (None, "dolt dolt"), (1003, "dolt " * 60_000), (0, quarrel[0][1])]
    table = docs(spark, [(d, t, None) for d, t, _ in quarrel] + [(d, t, None) for d, t in odd])
    labels = spark.createDataFrame(labelled((d, x) for d, _, x in quarrel) + [(0, 1, 1), (None, 0, 1), (3, 1, None), (77777, 0, 1)], LABELS)
    got = toxicity.toxicity(table, labels).collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == len(quarrel) + len(odd)
    assert {by_id[i].predicted for i in (1000, 1001, 1002)} == {0}
    assert by_id[1003].predicted == 1 and by_id[None].predicted == 1 and by_id[None].held_out is False


def test_rare_words_meet_their_examples(spark, quarrel):
    learnt = [i for i in range(5000, 5040) if zlib.crc32(str(i).encode()) % 5][:3]  # fewer texts than any threshold on counts
    rare = [(i, f"{quarrel[1][1]} zounderkite", True) for i in learnt]
    table = docs(spark, [(d, t, None) for d, t, _ in quarrel + rare] + [(6000, "Zounderkite!", None), (6001, "unheard", None), (6002, quarrel[1][1][:60], None)])
    labels = spark.createDataFrame(labelled((d, x) for d, _, x in quarrel + rare), LABELS)
    got = {r.doc_id: r for r in toxicity.toxicity(table, labels).collect()}
    assert got[6000].evidence and set(got[6000].evidence) <= set(learnt)
    assert got[6000].score > got[6001].score and got[6001].evidence == []
    assert len(got[6002].evidence) == toxicity.NEAREST  # plain words count as well


def test_toxicity_without_labels_or_documents(spark):
    none = spark.createDataFrame([], LABELS)
    assert toxicity.toxicity(docs(spark, []), none).collect() == []
    got = toxicity.toxicity(docs(spark, [(1, "words", None)]), none).collect()
    assert [(r.score, r.predicted) for r in got] == [(0.0, 0)]


def test_block_index_equals_scoring_everything():
    import numpy as np

    draw = np.random.default_rng(2)
    vectors = []
    for _ in range(500):
        terms = np.sort(draw.choice(40, draw.integers(0, 9), replace=False))
        weights = draw.random(len(terms)) + 0.1
        vectors.append((terms, weights / np.linalg.norm(weights) if len(terms) else weights))
    index = toxicity.ExampleIndex(np.arange(500), (np.arange(500) % 2).astype(float), vectors, 40)
    for terms, weights in vectors[:60]:
        dense = np.zeros(40)
        dense[terms] = weights
        every = np.array([sum(dense[t] * w for t, w in zip(*vectors[i], strict=True)) for i in index.ids])
        places, cosines = index.nearest(terms, weights, 10)
        best = np.sort(every[every > 0])[::-1][:10]
        assert np.allclose(np.sort(cosines)[::-1], best) and np.allclose(every[places], cosines)


def test_toxicity_accuracy_on_the_test_tables(spark):
    table, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    judged = toxicity.toxicity(table, labels).join(labels.select("doc_id", "toxic"), "doc_id").where("held_out")
    right = judged.agg(F.avg((F.col("toxic") == F.col("predicted")).cast("int"))).first()[0]
    assert right >= 0.93


# ---- decontamination


def plain(text):
    found, word = [], ""
    for ch in (text or "") + " ":
        if (ch.isascii() and ch.isalnum()) or not ch.isascii():
            word += ch.lower() if ch.isascii() else ch
        elif word:
            found.append(word)
            word = ""
    return found


def brute_contamination(rows, items):
    """Best window per document and item over every window of the item's length."""

    def shingles(words):
        return [tuple(words[k : k + 5]) for k in range(len(words) - 4)] if len(words) >= 5 else ([tuple(words)] if words else [])

    best = {}
    for doc_id, text in rows:
        found = shingles(plain(text))
        for item_id, item in items:
            target = shingles(plain(item))
            if not target or not found:
                continue
            width = min(len(target), len(found))
            for start in range(len(found) - width + 1):
                window = found[start : start + width]
                keys = set(window) | set(target)
                counts = [(window.count(k), target.count(k)) for k in keys]
                similarity = sum(map(min, counts)) / sum(map(max, counts))
                if similarity >= 0.75:
                    old = best.get((doc_id, item_id), (0, 0))
                    best[doc_id, item_id] = max(old, (similarity, -start))
    return {key: (round(s, 9), -start) for key, (s, start) in best.items()}


def test_planted_passages_match_brute_force(spark):
    draw = random.Random(12)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "naïve"]
    items = [(i, " ".join(draw.choices(vocabulary, k=draw.choice((3, 5, 9, 14, 14, 20, 33)))) + ".") for i in range(30)]
    items += [(30, items[3][1]), (31, None), (32, " - "), (None, "w1 w2 w3 w4 w5"), (3, items[3][1])]
    rows = []
    for d in range(50):
        said = draw.choices(vocabulary, k=draw.randint(0, 60))
        for _ in range(draw.randint(0, 2)):
            item = (items[draw.randrange(30)][1]).split()
            for _ in range(draw.choice((0, 0, 1, 2, 4))):
                item[draw.randrange(len(item))] = draw.choice(vocabulary).upper() + ","
            at = draw.randint(0, len(said))
            said[at:at] = item
        rows.append((d, "\n".join(said) if d % 3 else " ".join(said)))
    rows += [(60, None), (61, ""), (62, items[0][1]), (62, items[0][1]), (63, "w9 " * 30_000 + items[5][1])]
    table = docs(spark, [(d, t, None) for d, t in rows])
    benchmark = spark.createDataFrame([(i, t, "extra") for i, t in items], "item_id long, text string, doc_id string")
    got = {(r.doc_id, r.item_id): (round(r.similarity, 9), r.start) for r in decontam.contamination(table, benchmark).collect()}
    want = brute_contamination(rows[:-1], [x for x in items if x[0] is not None])
    assert {k: v for k, v in got.items() if k[0] != 63} == want
    assert (63, 5) in got
    clean = decontam.uncontaminated(table, benchmark)
    assert clean.schema == table.schema
    assert {r.doc_id for r in clean.collect()} == {d for d, _ in rows} - {d for d, _ in got}


def test_large_benchmarks_take_several_passes(spark, monkeypatch):
    monkeypatch.setattr(decontam, "ITEMS_AT_A_TIME", 2)
    items = [(i, " ".join(f"v{i}x{k}" for k in range(8))) for i in range(5)]
    table = docs(spark, [(i, f"before {t} after", None) for i, t in items])
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in decontam.contamination(table, benchmark).collect()) == [(i, i) for i in range(5)]
    assert decontam.uncontaminated(table, benchmark).count() == 0


def test_nothing_to_compare(spark):
    some, none = docs(spark, [(1, "a b c d e f", None)]), spark.createDataFrame([], "item_id long, text string")
    assert decontam.contamination(some, none).collect() == []
    assert decontam.uncontaminated(some, none).count() == 1
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert decontam.contamination(docs(spark, []), items).collect() == []


def test_hamming_blocks_miss_nothing_within_the_radius():
    import numpy as np

    draw = np.random.default_rng(1)
    prints = draw.integers(0, 256, (200, 8), dtype=np.uint8)
    near = np.stack([decontam._bytes_apart[:, prints[:, b]] <= decontam.RADIUS // decontam.BLOCKS for b in range(8)])
    for i in range(200):
        bits = np.unpackbits(prints[i])
        bits[draw.choice(64, decontam.RADIUS, replace=False)] ^= 1
        window = np.packbits(bits)
        assert any(near[b][window[b], i] for b in range(8))


def test_words_of_benchmarks_are_letters_and_digits():
    import pyarrow as pa

    from tallyhouse.llm.words import chunks

    a, b = (next(iter(chunks(pa.array([t]), NOT_PLAIN))).words.tolist() for t in ("Ab, c-1: É!", "ab c 1 É"))
    assert a == b


def test_copies_crowd_out_no_language(spark):
    """Probe: 40 documents of one language, 2 of another with many copies each."""
    draw = random.Random(2)
    some = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 != 2]
    rows = [(some[i], speech(draw, NORTH, 30), "no") for i in range(40)]
    rare = [(some[50 + i], speech(draw, SOUTH, 30), "su") for i in range(2)]
    table = docs(spark, rows + rare).union(docs(spark, rare).crossJoin(spark.range(1500)).drop("id"))
    sample = langid.drawn_texts(langid.learnable(table).select("doc_id", "text", "lang")).collect()
    assert sorted(r.lang for r in sample) == ["no"] * 40 + ["su"] * 2
    unseen = docs(spark, [(9000, speech(draw, SOUTH, 40), None), (9001, speech(draw, NORTH, 40), None)])
    got = {r.doc_id: r.lang_pred for r in langid.identify(table.union(unseen)).where("doc_id >= 9000").collect()}
    assert got == {9000: "su", 9001: "no"}


def test_copies_crowd_out_no_label(spark, quarrel):
    """Probe: clean documents, and 2 toxic ones with many copies each."""
    some = [(d, t, x) for d, t, x in quarrel if zlib.crc32(str(d).encode()) % 5]
    clean, bad = [(d, t) for d, t, x in some if not x][:60], [(d, t) for d, t, x in some if x][:2]
    table = docs(spark, [(d, t, None) for d, t in clean + bad]).union(docs(spark, [(d, t, None) for d, t in bad]).crossJoin(spark.range(2000)).drop("id"))
    labels = spark.createDataFrame(labelled([(d, 0) for d, _ in clean] + [(d, 1) for d, _ in bad]), LABELS)
    model = toxicity.fit(table, labels)
    assert sorted(set(model.index.labels)) == [0, 1] and len(model.index.ids) <= 62
    known = toxicity.labelled_texts(table, labels).withColumn("order", F.xxhash64("doc_id", "text"))
    assert toxicity.drawn_texts(known).count() == 62
    got = {r.doc_id: r.score for r in toxicity.toxicity(table, labels).dropDuplicates(["doc_id"]).collect()}
    assert min(got[d] for d, _ in bad) > max(got[d] for d, _ in clean)


def test_nearest_centroid_by_brute_force(spark, two_tongues):
    """Counts of n-grams, weights, cosines and the nearest centroid once more, one text at a time."""
    model = langid.fit(langid.learnable(docs(spark, two_tongues)))
    got = {r.doc_id: r for r in langid.identify(docs(spark, two_tongues)).collect()}
    for doc_id, text, _ in two_tongues:
        (counts,), _ = langid.gram_counts([text])
        weighted = [math.log1p(c) * w for c, w in zip(counts, model.idf, strict=True)]
        norm = math.sqrt(sum(x * x for x in weighted))
        cosines = [sum(a * b for a, b in zip(weighted, v, strict=True) if a) / norm for v in model.vectors]
        best = max(range(len(cosines)), key=lambda i: (cosines[i], -i))
        assert got[doc_id].lang_pred == model.languages[best]
        assert got[doc_id].score == pytest.approx(min(1, max(0, cosines[best])), abs=1e-4)
