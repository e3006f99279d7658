"""Toxicity by nearest labelled examples.

A text is its normalised TF-IDF vector over its words and the first four bytes of
longer words. The vocabulary is every one of these that the examples hold; others
could meet no example and, as in the fitting of any TF-IDF, are no part of the
vector or its length. A word that comes with toxic labels weighs the more, the
surer that is: its IDF is multiplied by one plus the root of its chi-square.

The nearest examples by exact cosine come from an inverted index in blocks: for
every word and block of examples the index knows the largest weight, so a block
whose bound cannot reach the k-th cosine is never read. The nearest examples vote
by cosine; the vote is calibrated on labelled texts that are no examples, and the
ids of the voters are the evidence.

Document frequencies cover all labelled rows that may be learnt from. The examples
are a bounded sample, at most ``EXAMPLES_PER_LABEL`` of each label, as are the texts
of the calibration.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..workspace import sized, stage
from .words import NOT_PLAIN, Chunk, chunks

EXAMPLES_PER_LABEL = 1500
CALIBRATION_PER_LABEL = 1000
NEAREST = 15
BLOCK = 64  # examples
BLOCKS_FIRST = 4  # blocks read before the others are measured against the k-th cosine

WORD_COUNTS = "word long, texts long, toxic long"


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def labelled_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, toxic) of the labelled rows that may be learnt from.

    A document that is labelled both ways counts once, as toxic.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # Labels are few and narrow: as long as they are, no text has to travel to meet them.
    return texts.where("text is not null").join(sized(stage(known, "labels")), "doc_id").select("doc_id", "text", "toxic")


def _found(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and beginnings of a chunk, and the text of each."""
    text = np.repeat(np.arange(len(chunk.at) - 1), np.diff(chunk.at))
    begun = chunk.beginnings != 0
    return np.concatenate((chunk.words, chunk.beginnings[begun])), np.concatenate((text, text[begun]))


def _word_sets(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct hashes of every text's words and beginnings, and how often each occurs."""
    for chunk in chunks(column, NOT_PLAIN):
        for a, b in zip(chunk.at[:-1], chunk.at[1:], strict=True):
            begun = chunk.beginnings[a:b]
            yield np.unique(np.concatenate((chunk.words[a:b], begun[begun != 0])), return_counts=True)


@dataclass
class Vocabulary:
    words: np.ndarray  # sorted hashes
    worth: np.ndarray  # IDF times how well the word tells toxic texts

    def counts(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Word numbers of every text, and how often each occurs; one lookup for all texts of a chunk."""
        size = max(1, len(self.words))
        for chunk in chunks(column, NOT_PLAIN):
            hashes, text = _found(chunk)
            hashes, place = np.unique(hashes, return_inverse=True)
            at = np.minimum(np.searchsorted(self.words, hashes), size - 1)
            number = np.where(self.words[at] == hashes, at, -1)[place] if len(self.words) else np.full(len(place), -1)
            known = number >= 0
            pairs, many = np.unique(text[known] * size + number[known], return_counts=True)
            edges = np.searchsorted(pairs, np.arange(len(chunk.at)) * size)
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                yield pairs[a:b] % size, many[a:b]

    def vector(self, terms: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers and normalised weights."""
        weights = (1 + np.log(many)) * self.worth[terms]
        norm = np.sqrt((weights * weights).sum())
        return terms, (weights / norm if norm else weights)

    def vectors(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for terms, many in self.counts(column):
            yield self.vector(terms, many)


def fit_vocabulary(texts: DataFrame, words: np.ndarray) -> Vocabulary:
    """``words`` (sorted hashes) with their document frequencies, and toxic ones, over all labelled texts."""
    sizes = texts.agg(F.count("*").alias("all"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")).first()
    every, toxic = float(sizes["all"]), float(sizes["toxic"])
    found = Vocabulary(words, np.zeros(len(words)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, len(words)), np.int64)
        for batch in batches:
            labels = batch.column("toxic").to_numpy(zero_copy_only=False)
            for label, (terms, _) in zip(labels, found.counts(batch.column("text")), strict=True):
                seen[0, terms] += 1
                seen[1, terms] += int(label)
        word = np.flatnonzero(seen[0])
        yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(seen[0, word]), pa.array(seen[1, word])], ["word", "texts", "toxic"])

    counted = (
        texts.select("text", "toxic").mapInArrow(count, WORD_COUNTS).groupBy("word").agg(F.sum("texts").alias("texts"), F.sum("toxic").alias("toxic"))
    ).toArrow()
    of_all, of_toxic = np.zeros(len(words)), np.zeros(len(words))
    place = counted["word"].to_numpy()
    of_all[place], of_toxic[place] = counted["texts"].to_numpy(), counted["toxic"].to_numpy()
    off = of_toxic * every - of_all * toxic
    spread = np.maximum(1.0, of_all * (every - of_all)) * max(1.0, toxic * (every - toxic))
    tells = np.sqrt(np.maximum(0.0, off) ** 2 * every / spread)
    found.worth = np.log((1 + every) / (1 + of_all)) * (1 + tells)
    return found


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions of several ranges, one range after another."""
    return np.arange(sizes.sum()) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes)


class ExampleIndex:
    """Inverted lists of examples in blocks, with the largest weight per word and block."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: list[tuple[np.ndarray, np.ndarray]], words: int):
        # Examples of like words lie side by side, which keeps the bounds of blocks apart.
        order = np.array(sorted(range(len(ids)), key=lambda i: (labels[i], vectors[i][0][np.argmax(vectors[i][1])] if len(vectors[i][0]) else -1, ids[i])), np.int64)
        self.ids, self.labels = ids[order], labels[order]
        terms = np.concatenate([vectors[i][0] for i in order]).astype(np.int64)
        places = np.repeat(np.arange(len(order)), [len(vectors[i][0]) for i in order])
        by_word = np.lexsort((places, terms))
        terms, self.places = terms[by_word], places[by_word].astype(np.int32)
        self.weights = np.concatenate([vectors[i][1] for i in order])[by_word]
        # One entry per word and block: its postings and their largest weight.
        blocks = self.places // BLOCK
        first = np.flatnonzero(np.diff(terms, prepend=-1) | np.diff(blocks, prepend=-1)) if len(terms) else np.zeros(0, np.int64)
        self.blocks, self.most = blocks[first], np.maximum.reduceat(self.weights, first) if len(first) else np.zeros(0)
        self.begin = np.append(first, len(terms))  # of an entry, in the postings
        self.entries = np.searchsorted(terms[first], np.arange(words + 1))  # of a word, in the entries

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and cosines of the k nearest examples that share a word; equal cosines by place."""
        many = self.entries[terms + 1] - self.entries[terms]
        entries, weights = _spans(self.entries[terms], many), np.repeat(weights, many)
        blocks = self.blocks[entries]
        # Bounds and cosines are summed in the same order, so rounding lifts no cosine above its bound.
        bounds = np.bincount(blocks, weights * self.most[entries], minlength=-(-len(self.ids) // BLOCK))
        cosines, read = np.zeros(len(self.ids)), np.zeros(len(bounds), bool)
        wanted = np.zeros(len(bounds), bool)
        wanted[np.argsort(-bounds, kind="stable")[:BLOCKS_FIRST]] = True
        while wanted.any():
            own = np.flatnonzero(wanted[blocks])
            sizes = self.begin[entries[own] + 1] - self.begin[entries[own]]
            postings = _spans(self.begin[entries[own]], sizes)
            cosines += np.bincount(self.places[postings], np.repeat(weights[own], sizes) * self.weights[postings], minlength=len(cosines))
            read |= wanted
            kth = np.partition(cosines, -k)[-k] if len(cosines) >= k else 0.0
            wanted = ~read & (bounds > 0) & (bounds >= kth)
        places = np.flatnonzero(cosines > 0)
        places = places[np.lexsort((places, -cosines[places]))[:k]]
        return places, cosines[places]


@dataclass
class Model:
    vocabulary: Vocabulary
    index: ExampleIndex | None
    prior: float  # share of toxic rows
    edges: np.ndarray  # votes seen in the calibration, rising
    chances: np.ndarray  # share of toxic texts at each

    def vote(self, terms: np.ndarray, weights: np.ndarray) -> tuple[float, np.ndarray]:
        """Share of the nearest examples' cosines that is toxic, drawn to the prior; the voters."""
        if self.index is None or not len(terms):
            return self.prior, np.zeros(0, np.int64)
        places, cosines = self.index.nearest(terms, weights, NEAREST)
        # An example counts the more, the nearer it is; one vote's worth of prior keeps far ones from deciding.
        pull = cosines**2
        share = float((pull * self.index.labels[places]).sum() + 0.1 * self.prior) / float(pull.sum() + 0.1)
        return share, self.index.ids[places]

    def score(self, vote: float) -> float:
        if not len(self.chances):
            return min(1.0, max(0.0, vote))
        return float(np.interp(vote, self.edges, self.chances))


def _monotone(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The rising sequence nearest to ``values``, by pooling neighbours that fall."""
    pools: list[list[float]] = []
    for value, size in zip(values, sizes, strict=True):
        pools.append([float(value), float(size), 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            b, a = pools.pop(), pools.pop()
            pools.append([(a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2] + b[2]])
    return np.concatenate([np.full(int(p[2]), p[0]) for p in pools])


def drawn_texts(texts: DataFrame) -> DataFrame:
    """The bounded sample: (doc_id, toxic, n, text), n counting from 1 within each label.

    Rows are told apart by doc_id and text first, so copies neither crowd out others
    nor come along: of every label the rows with the smallest digests, whatever their
    number. Ranks are cut to the bound within each task before they meet.
    """
    keys = texts.select("doc_id", "toxic", "order").distinct()
    order = Window.partitionBy("toxic").orderBy("order", "doc_id")
    ranked = keys.withColumn("n", F.row_number().over(order)).where(F.col("n") <= EXAMPLES_PER_LABEL + CALIBRATION_PER_LABEL)
    drawn = texts.join(F.broadcast(stage(ranked, "drawn")), ["doc_id", "toxic", "order"])
    return drawn.groupBy("doc_id", "toxic", "order", "n").agg(F.min("text").alias("text")).drop("order")


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from the labelled documents; without any, every text scores 0."""
    texts = stage(labelled_texts(docs, labels).withColumn("order", F.xxhash64("doc_id", "text")), "labelled")
    sizes = {r["toxic"]: r["count"] for r in texts.groupBy("toxic").count().collect()}
    sample = stage(drawn_texts(texts), "sample")
    every = sum(sizes.values())
    prior = sizes.get(1, 0) / every if every else 0.0
    # Small tables share what they have between examples and calibration.
    share = EXAMPLES_PER_LABEL / (EXAMPLES_PER_LABEL + CALIBRATION_PER_LABEL)
    most = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.max("n").alias("n")).collect()}
    last = F.coalesce(*(F.when(F.col("toxic") == label, max(1.0, n * share)) for label, n in most.items()), F.lit(0.0))
    examples, rest = sample.where(F.col("n") <= last), sample.where(F.col("n") > last)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [words for words, _ in _word_sets(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(found)).view(np.int64) if found else [], pa.int64())], ["word"])

    words = examples.select("text").mapInArrow(hashed, "word long").distinct().toArrow()["word"].to_numpy()
    vocabulary = fit_vocabulary(texts, np.sort(words.view(np.uint64)))

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(vocabulary.vectors(batch.column("text")))
            numbers, weights = [t.astype(np.int32).tobytes() for t, _ in found], [w.tobytes() for _, w in found]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), batch.column("n"), pa.array(numbers, pa.binary()), pa.array(weights, pa.binary())], ["doc_id", "toxic", "n", "terms", "weights"])

    known = examples.select("doc_id", "toxic", "n", "text").mapInArrow(numbered, "doc_id long, toxic int, n int, terms binary, weights binary").toArrow()
    known = known.sort_by([("toxic", "ascending"), ("n", "ascending"), ("doc_id", "ascending")])
    vectors = [(np.frombuffer(t.as_buffer(), np.int32).astype(np.int64), np.frombuffer(w.as_buffer(), np.float64)) for t, w in zip(known["terms"], known["weights"], strict=True)]
    ids, toxic = known["doc_id"].to_numpy(), known["toxic"].to_numpy().astype(np.float64)
    index = ExampleIndex(ids, toxic, vectors, len(vocabulary.words)) if len(ids) else None
    model = Model(vocabulary, index, prior, np.zeros(0), np.zeros(0))

    def voted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            votes = [model.vote(*vector)[0] for vector in vocabulary.vectors(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(votes, pa.float64())], ["toxic", "vote"])

    calibration = rest.select("toxic", "text").mapInArrow(voted, "toxic int, vote double").toArrow()
    truth, votes = calibration["toxic"].to_numpy(), calibration["vote"].to_numpy()
    if index is not None and len(np.unique(truth)) == 2:
        drawn_of = np.bincount(truth, minlength=2)
        weight = np.array([sizes[0] / drawn_of[0], sizes[1] / drawn_of[1]])[truth]  # back to the labels' true shares
        model.edges, level = np.unique(votes, return_inverse=True)
        size = np.bincount(level, weights=weight)
        chance = np.bincount(level, weights=weight * truth) / size
        model.chances = _monotone(chance, size)
    return model


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted, evidence.

    Only doc_id and text are read, and labels to learn. Rows that repeat are scored
    each time, and drawn as examples once. A NULL or wordless text
    has the score of a text that shares no word with an example. ``evidence`` lists the ids
    of the nearest examples, nearest first.
    """
    model = fit(docs, labels)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, evidence = [], []
            for terms, weights in model.vocabulary.vectors(batch.column("text")):
                vote, voters = model.vote(terms, weights)
                scores.append(model.score(vote))
                evidence.append(voters)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32()), pa.array(evidence, pa.list_(pa.int64()))],
                ["doc_id", "held_out", "score", "predicted", "evidence"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id").cast("long")).alias("held_out"), F.col("text").cast("string").alias("text")
    )
    return rows.mapInArrow(judge, "doc_id long, held_out boolean, score double, predicted int, evidence array<long>")
