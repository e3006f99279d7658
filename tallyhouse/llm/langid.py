"""Language identification by nearest centroids.

A text becomes its normalised TF-IDF vector of hashed character 1-, 2- and
3-grams. Every language has a few centroids, found by clustering the vectors of
a bounded sample of its labelled texts; a text takes the language of the centroid
with the largest cosine. A text whose cosine is far below what the sample's texts
of similar length have to their own language is rejected.

The document frequencies cover all learnable rows; only the clustering uses the
sample, of at most ``SAMPLE_PER_LANGUAGE`` texts a language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..workspace import sized, stage

GRAMS = 4096  # hashed n-gram features
ORDERS = 3
CENTROIDS = 4  # clusters per language
SAMPLE_PER_LANGUAGE = 400
ROUNDS = 8  # of the clustering
TEXTS_AT_A_TIME, CHARS_AT_A_TIME = 64, 1 << 18
# Rejected: a cosine below this share of the sample's lowest percentile at that length.
REJECT_BELOW = 0.5
UNDETERMINED = "und"


_is_letter: dict[str, np.ndarray] = {}  # made once in each worker, not sent to it


def _letters() -> np.ndarray:
    if "table" not in _is_letter:
        _is_letter["table"] = np.fromiter((chr(i).isalpha() for i in range(0x110000)), np.bool_, 0x110000)
    return _is_letter["table"]


def gram_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of hashed n-grams (texts x GRAMS) and the letters of each text.

    Runs of what is no letter count as one blank; a text starts and ends with one.
    """
    points = np.frombuffer((" " + "  ".join(texts) + " ").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    # Lower-casing may change a text's length; where it does, measure it again.
    lengths = np.array([len(t.lower()) for t in texts], np.int64)
    owner = np.repeat(np.arange(len(texts)), lengths + 2)
    letter = _letters()[points]
    points = np.where(letter, points, 32).astype(np.uint32)
    edge = np.concatenate(([True], owner[1:] != owner[:-1]))
    keep = letter | edge
    keep[1:] |= letter[:-1]
    points, owner, letter = points[keep], owner[keep], letter[keep]
    counts = np.zeros(len(texts) * GRAMS, np.int64)
    grams = np.zeros(len(points), np.uint32)
    for order in range(1, ORDERS + 1):
        n = len(points) - order + 1
        if n <= 0:
            break
        grams = grams[:n] * np.uint32(0x9E3779B1) + points[order - 1 :] + np.uint32(order)
        hashed = grams ^ (grams >> np.uint32(15))
        hashed = hashed * np.uint32(0x85EBCA6B)
        slot = (hashed >> np.uint32(20)).astype(np.int64)
        inside = owner[:n] == owner[order - 1 :]
        if order == 1:
            inside = inside & letter
        counts += np.bincount(owner[:n][inside] * GRAMS + slot[inside], minlength=len(counts))
    return counts.reshape(len(texts), GRAMS), np.bincount(owner[letter], minlength=len(texts))


def _portions(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    first = 0
    while first < len(texts):
        last, chars = first, 0
        while last < len(texts) and last - first < TEXTS_AT_A_TIME and (last == first or chars + len(texts[last]) <= CHARS_AT_A_TIME):
            chars += len(texts[last])
            last += 1
        yield first, texts[first:last]
        first = last


def _frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    found, texts = np.zeros(GRAMS, np.int64), 0
    for batch in batches:
        for _, part in _portions(batch["text"].tolist()):
            counts, letters = gram_counts(part)
            found += (counts > 0).sum(axis=0)
            texts += int((letters > 0).sum())
    yield pd.DataFrame({"slot": np.append(np.arange(GRAMS), -1), "texts": np.append(found, texts)})


def _sampled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for first, part in _portions(batch["text"].tolist()):
            counts, letters = gram_counts(part)
            for i in np.flatnonzero(letters):
                slots = np.flatnonzero(counts[i])
                yield pd.DataFrame(
                    {"lang": [batch["lang"].iloc[first + i]], "letters": [int(letters[i])], "slots": [slots], "counts": [counts[i][slots]]}
                )


def _unit(vectors: np.ndarray) -> np.ndarray:
    norms = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    return vectors / np.where(norms > 0, norms, 1)


def _weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return _unit((np.log1p(counts) * idf).astype(np.float32))


def _length_class(letters: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(letters, 1)).astype(np.int64), 10)


def clustered(vectors: np.ndarray) -> np.ndarray:
    """Spherical k-means, started from the vectors that lie farthest apart."""
    centres = [int(np.argmax(vectors @ vectors.mean(axis=0)))]
    closest = vectors @ vectors[centres[0]]
    while len(centres) < min(CENTROIDS, len(vectors)):
        centres.append(int(np.argmin(closest)))
        closest = np.maximum(closest, vectors @ vectors[centres[-1]])
    centroids = vectors[centres]
    for _ in range(ROUNDS):
        nearest = np.argmax(vectors @ centroids.T, axis=1)
        sums = [vectors[nearest == c].sum(axis=0) if (nearest == c).any() else centroids[c] for c in range(len(centroids))]
        centroids = _unit(np.stack(sums))
    return centroids


@dataclass
class Centroids:
    languages: list[str]  # of each centroid
    vectors: np.ndarray  # centroids x GRAMS
    idf: np.ndarray
    floors: np.ndarray  # lowest accepted cosine by class of length


def drawn_texts(usable: DataFrame) -> DataFrame:
    """The bounded sample (lang, text): of every language the distinct texts with the smallest digests.

    Copies of a text count once, so they crowd out no language and bring no further
    row along. Ranks are cut to the bound within each task before they meet.
    """
    usable = usable.withColumn("order", F.xxhash64("doc_id", "text")).withColumn("text_hash", F.xxhash64("text"))
    keys = usable.groupBy("lang", "text_hash").agg(F.min("order").alias("order"))
    first = Window.partitionBy("lang").orderBy("order", "text_hash")
    ranked = keys.withColumn("n", F.row_number().over(first)).where(F.col("n") <= SAMPLE_PER_LANGUAGE)
    drawn = usable.join(sized(stage(ranked.select("lang", "text_hash", "order"), "drawn")), ["lang", "text_hash", "order"])
    return drawn.groupBy("lang", "text_hash").agg(F.min("text").alias("text")).select("lang", "text")


def fit(labelled: DataFrame) -> Centroids | None:
    """Learn from ``labelled`` (doc_id, text, lang); None if no row has a language and a letter."""
    usable = labelled.where("lang is not null and text is not null").select("doc_id", "text", "lang")
    frequency = (
        usable.select("text").mapInPandas(_frequencies, "slot int, texts long").groupBy("slot").agg(F.sum("texts").alias("texts"))
    )
    per_slot = {r.slot: r.texts for r in frequency.collect()}  # GRAMS + 1 rows at any size
    texts = per_slot.get(-1, 0)
    if not texts:
        return None
    present = np.array([per_slot[s] for s in range(GRAMS)], np.float64)
    idf = np.log((1 + texts) / (1 + present)) + 0.1

    sample = drawn_texts(usable).mapInPandas(_sampled, "lang string, letters long, slots array<int>, counts array<int>").toArrow().to_pandas().sort_values(["lang", "letters"], kind="stable")
    languages, centroids, lengths, cosines = [], [], [], []
    for lang, own in sample.groupby("lang", sort=True):
        counts = np.zeros((len(own), GRAMS))
        for i, (slots, many) in enumerate(zip(own["slots"], own["counts"], strict=True)):
            counts[i, slots] = many
        vectors = _weighted(counts, idf)
        # Equal vectors in a fixed order make the clustering repeatable.
        vectors = vectors[np.lexsort(vectors[:, :8].T)]
        found = clustered(vectors)
        languages += [lang] * len(found)
        centroids.append(found)
        lengths.append(own["letters"].to_numpy())
        cosines.append(np.sort((_weighted(counts, idf) @ found.T).max(axis=1)))
    every_length, every_cosine = np.concatenate([np.sort(x) for x in lengths]), np.concatenate(cosines)
    lowest = np.quantile(every_cosine, 0.01)
    # Short texts lie farther from any centroid: their floor shrinks with their length.
    classes = np.arange(11)
    floors = REJECT_BELOW * lowest * np.minimum(1, classes / max(1.0, float(_length_class(np.array([np.median(every_length)]))[0])))
    return Centroids(languages, np.concatenate(centroids), idf, floors)


def classify(texts: list, model: Centroids | None) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, cosine to the nearest centroid, and whether the text is rejected."""
    langs, scores, rejected = [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
    if model is None:
        return langs, scores, rejected
    for first, part in _portions([t if isinstance(t, str) else "" for t in texts]):
        counts, letters = gram_counts(part)
        cosines = _weighted(counts, model.idf) @ model.vectors.T
        best = np.argmax(cosines, axis=1)
        for i in np.flatnonzero(letters):
            langs[first + i] = model.languages[best[i]]
            scores[first + i] = min(1.0, max(0.0, float(cosines[i, best[i]])))
        rejected[first : first + len(part)] = (letters == 0) | (
            cosines.max(axis=1) < model.floors[_length_class(letters)]
        )
    return langs, scores, rejected


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def learnable(docs: DataFrame) -> DataFrame:
    """The rows a model may learn from: a document id that is not held out, a text and a language."""
    rows = docs.select(*(F.col(c).cast(t).alias(c) for c, t in (("doc_id", "long"), ("text", "string"), ("lang", "string"))))
    return rows.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))


def identify(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score, rejected.

    Only doc_id, text and (for learning) lang are read. A NULL text or one
    without a letter is ``und`` with score 0 and rejected, as is every text when
    nothing can be learnt. Rows that repeat are judged each time, and drawn for the
    model once. Equal cosines go to the language first in the
    alphabet. A row without doc_id is judged but never learnt from.
    """
    model = fit(learnable(docs))

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            langs, scores, rejected = classify(batch["text"].tolist(), model)
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"].to_numpy(), "held_out": batch["held_out"], "lang_pred": langs, "score": scores, "rejected": rejected}
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out(F.col("doc_id").cast("long")).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )
    return rows.mapInPandas(judge, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def identified_only(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents whose language is rejected; every other column as it came."""
    model = fit(learnable(docs))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, _, rejected = classify(batch.column("text").cast(pa.string()).to_pylist(), model)
            yield batch.filter(pa.array(~rejected))

    return docs.mapInArrow(keep, docs.schema)
