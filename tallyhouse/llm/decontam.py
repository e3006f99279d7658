"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact check.

A document is compared with a benchmark item over all windows of the item's
length in words. Every window that holds a shingle of the item (any other has
similarity 0) gets a 64-bit SimHash over its weighted shingles. Fingerprints are
cut into 8 blocks; an index knows, for every block and byte, the items whose
block lies within RADIUS // 8 bits of that byte. A fingerprint within RADIUS
bits of an item's is within RADIUS // 8 bits in one block at least, so the index
misses none. What it finds within RADIUS is verified by exact weighted-shingle
similarity: the sum of the smaller over the sum of the larger counts of every
five-word shingle.

At similarity 0.75 the expected distance is 11 bits of 64 with a deviation of 3;
the radius of 23 lies four deviations above.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import NOT_PLAIN, chunks, shingles

BITS, BLOCKS, RADIUS = 64, 8, 23
LEAST_SIMILARITY = 0.75
ITEMS_AT_A_TIME = 4000  # items sent to the executors at once; a larger benchmark takes several passes
PRESENCE_BITS = 20

FOUND = "doc_id long, item_id long, similarity double, start long, n_words long"

_bytes_apart = np.array([[bin(a ^ b).count("1") for b in range(256)] for a in range(256)], np.uint8)


def _signs(hashes: np.ndarray) -> np.ndarray:
    """+1 or -1 for every bit of every hash."""
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).astype(np.int32) * 2 - 1


def fingerprint_windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """SimHash bytes (windows x 8) of all windows of ``width`` shingles; a shingle weighs as often as it occurs."""
    running = np.zeros((len(hashes) + 1, BITS), np.int32)
    np.cumsum(_signs(hashes), axis=0, out=running[1:])
    return np.packbits((running[width:] - running[:-width]) > 0, axis=1)


def weighted_similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Sum of smaller over sum of larger counts of two multisets of hashes."""
    values, inverse = np.unique(np.concatenate((a, b)), return_inverse=True)
    in_a = np.bincount(inverse[: len(a)], minlength=len(values))
    in_b = np.bincount(inverse[len(a) :], minlength=len(values))
    return float(np.minimum(in_a, in_b).sum() / np.maximum(in_a, in_b).sum())


class ItemIndex:
    """A bounded number of items: their shingles, fingerprints and Hamming blocks by width."""

    def __init__(self, ids: list[int], texts: list[str]):
        self.ids, self.hashes, self.words = [], [], []
        column = pa.array(texts, pa.string())
        for chunk in chunks(column, NOT_PLAIN):
            found, begin = shingles(chunk.words, chunk.at)
            for i, (a, b) in enumerate(zip(begin[:-1], begin[1:], strict=True)):
                if b > a:
                    self.ids.append(ids[chunk.first + i])
                    self.hashes.append(found[a:b])
                    self.words.append(int(chunk.at[i + 1] - chunk.at[i]))
        everything = np.concatenate(self.hashes) if self.hashes else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(self.ids)), [len(h) for h in self.hashes]).astype(np.int64)
        order = np.argsort(everything, kind="stable")
        self.known, self.known_by = everything[order], owner[order]
        self.present = np.zeros(1 << PRESENCE_BITS, np.bool_)
        self.present[everything >> np.uint64(64 - PRESENCE_BITS)] = True
        self.of_width: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for width in sorted({len(h) for h in self.hashes}):
            own = np.array([i for i, h in enumerate(self.hashes) if len(h) == width])
            prints = np.concatenate([fingerprint_windows(self.hashes[i], width) for i in own])
            near = np.zeros((BLOCKS, 256, len(own)), np.bool_)
            for block in range(BLOCKS):
                near[block] = _bytes_apart[:, prints[:, block]] <= RADIUS // BLOCKS
            self.of_width[width] = own, prints, near

    def hits(self, found: np.ndarray) -> np.ndarray:
        """Positions of shingles that some item has."""
        if not len(self.known):
            return np.zeros(0, np.int64)
        likely = np.flatnonzero(self.present[found >> np.uint64(64 - PRESENCE_BITS)])
        at = np.minimum(np.searchsorted(self.known, found[likely]), len(self.known) - 1)
        return likely[self.known[at] == found[likely]]

    def matches(self, own: np.ndarray, hits: np.ndarray) -> Iterator[tuple[int, float, int]]:
        """(item, similarity, first word) of the best window per item in one document's shingles."""
        left, right = np.searchsorted(self.known, own[hits], "left"), np.searchsorted(self.known, own[hits], "right")
        where: dict[int, set[int]] = {}
        for position, a, b in zip(hits, left, right, strict=True):
            for item in self.known_by[a:b]:
                where.setdefault(len(self.hashes[item]), set()).add(int(position))
        for width, positions in where.items():
            items, prints, near = self.of_width[width]
            for first, last in _stretches(sorted(positions), width):
                stretch = own[max(0, first - width + 1) : last + width]
                taken = min(width, len(stretch))  # a shorter document is one window
                windows = fingerprint_windows(stretch, taken)
                indexed = np.zeros((len(windows), len(items)), np.bool_)
                for block in range(BLOCKS):
                    indexed |= near[block][windows[:, block]]
                at, which = np.nonzero(indexed)
                apart = _bytes_apart[windows[at], prints[which]].sum(axis=1)
                at, which = at[apart <= RADIUS], which[apart <= RADIUS]
                for k in np.unique(which):
                    item = items[k]
                    best = max(
                        (weighted_similarity(stretch[s : s + taken], self.hashes[item]), -int(s)) for s in at[which == k]
                    )
                    if best[0] >= LEAST_SIMILARITY:
                        yield int(item), best[0], max(0, first - width + 1) - best[1]


def _stretches(positions: list[int], width: int) -> Iterator[tuple[int, int]]:
    """Runs of positions so close that their windows overlap."""
    first = last = positions[0]
    for p in positions[1:]:
        if p - last >= width:
            yield first, last
            first = p
        last = p
    yield first, last


def _scan(index: ItemIndex, column: pa.Array) -> Iterator[tuple[int, int, float, int]]:
    """(row, item, similarity, first word) for every text and item found in it."""
    for chunk in chunks(column, NOT_PLAIN):
        found, begin = shingles(chunk.words, chunk.at)
        hits = index.hits(found)
        if not len(hits):
            continue
        row = np.searchsorted(begin, hits, "right") - 1
        for r in np.unique(row):
            own = found[begin[r] : begin[r + 1]]
            best: dict[int, tuple[float, int]] = {}
            for item, similarity, start in index.matches(own, hits[row == r] - begin[r]):
                best[item] = max(best.get(item, (0.0, 0)), (similarity, -start))
            for item, (similarity, start) in sorted(best.items()):
                yield chunk.first + int(r), item, similarity, -start


def _item_indexes(benchmark: DataFrame) -> Iterator[ItemIndex]:
    """The benchmark in portions of bounded size, each a pass over the documents."""
    items = (
        benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
        .where("item_id is not null and text is not null")
        .distinct()
    )
    last = None
    while True:
        rest = items if last is None else items.where((F.col("item_id") > last[0]) | ((F.col("item_id") == last[0]) & (F.col("text") > last[1])))
        portion = rest.orderBy("item_id", "text").limit(ITEMS_AT_A_TIME).collect()
        if portion:
            yield ItemIndex([r.item_id for r in portion], [r.text for r in portion])
            last = portion[-1]
        if len(portion) < ITEMS_AT_A_TIME:
            return


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and benchmark item found in it: doc_id, item_id, similarity, start, n_words.

    ``start`` is the first word of the most similar window (the first of equals),
    ``n_words`` the item's length. Words are runs of letters and digits, A-Z
    lower-cased. Items of fewer than five words count as one shingle and are found
    only as a whole document. NULL or wordless texts contain nothing and are
    contained in nothing; repeated rows give one result; a row without doc_id
    is reported once without it. An empty benchmark or table gives no row.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    every = docs.sparkSession.createDataFrame([], FOUND)
    for index in _item_indexes(benchmark):

        def find(batches: Iterator[pa.RecordBatch], index: ItemIndex = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column("doc_id").to_pylist()
                rows = [(ids[r], index.ids[i], s, at, index.words[i]) for r, i, s, at in _scan(index, batch.column("text"))]
                yield pa.RecordBatch.from_pandas(
                    pd.DataFrame(rows, columns=["doc_id", "item_id", "similarity", "start", "n_words"]).astype({"doc_id": "Int64"}),
                    pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("similarity", pa.float64()), ("start", pa.int64()), ("n_words", pa.int64())]),
                    preserve_index=False,
                )

        every = every.unionByName(texts.mapInArrow(find, FOUND))
    best = every.groupBy("doc_id", "item_id").agg(F.max(F.struct("similarity", (-F.col("start")).alias("back"), "n_words")).alias("best"))
    return best.select(
        "doc_id", "item_id", F.col("best.similarity").alias("similarity"), (-F.col("best.back")).alias("start"), F.col("best.n_words").alias("n_words")
    )


def uncontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item; nothing is joined or shuffled."""
    for index in _item_indexes(benchmark):

        def keep(batches: Iterator[pa.RecordBatch], index: ItemIndex = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = np.ones(batch.num_rows, np.bool_)
                clean[[r for r, *_ in _scan(index, batch.column("text"))]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
