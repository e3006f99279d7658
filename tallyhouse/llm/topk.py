"""Exact top-k inner products by the threshold algorithm over sorted per-dimension lists.

Candidates lie in blocks of bounded size; a block has, for every dimension, the
list of its vectors sorted by that component. A query reads all lists downwards
from the end its own component favours, scores what it sees for the first time,
and stops as soon as the bound, the sum of what the lists have reached, cannot
reach its k-th score any more. Queries travel in packs to every block, each pair
of pack and block is one unit of work, and the best k per block are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..workspace import discard, stage

SCALE = 64
BLOCK_ROWS, PACK_ROWS = 8192, 512
FIRST_DEPTH = 64  # list entries read before the bound is first compared
EXACT_IN_DOUBLE = 2**53
EXACT_IN_LONG = 2**62  # sums of absolute products, taken in doubles, below which no step leaves a long
LARGEST = 2**63  # components beyond are no long

PACKED = "dims int, unit long, ids binary, vectors binary"
BEST = "query_id long, vec_id long, score long"


def whole_numbers(vectors: DataFrame) -> DataFrame:
    """(vec_id, whole, dims): floor(64 x) of usable vectors.

    Left out: rows without vec_id, vectors that are NULL, empty or hold a NULL,
    a non-finite component or one that fits no long (2**63 and beyond after scaling).
    """
    numbers = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE))
    usable = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * SCALE) < float(LARGEST))
    )
    return (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
        .where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0))
        .where(F.coalesce(usable, F.lit(False)))
        .select("vec_id", numbers.alias("whole"), F.size("embedding").alias("dims"))
    )


def _packs(rows: DataFrame, size: int) -> DataFrame:
    """Rows of equal dimension in packs of about ``size``, one row each."""
    many = rows.groupBy("dims").count().collect()  # one row per dimension
    packs: Column = F.lit(1)
    for r in many:
        packs = F.when(F.col("dims") == r["dims"], max(1, -(-r["count"] // size))).otherwise(packs)

    def pack(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("vec_id", kind="stable")
        vectors = np.stack(own["whole"].to_numpy()).astype(np.int64)
        largest = np.abs(vectors).max(initial=0)
        vectors = vectors.astype(np.int16 if largest < 2**15 else np.int32 if largest < 2**31 else np.int64)
        return pd.DataFrame(
            {
                "dims": [int(own["dims"].iloc[0])],
                "unit": [int(own["unit"].iloc[0])],
                "ids": [own["vec_id"].to_numpy(np.int64).tobytes()],
                "vectors": [vectors.tobytes()],
            }
        )

    placed = rows.withColumn("unit", F.pmod(F.xxhash64("vec_id", F.lit(7)), packs.cast("long")))
    return placed.groupBy("dims", "unit").applyInPandas(pack, PACKED)


def _unpacked(ids: bytes, vectors: bytes, dims: int) -> tuple[np.ndarray, np.ndarray]:
    own = np.frombuffer(ids, np.int64)
    kind = {2: np.int16, 4: np.int32, 8: np.int64}[len(vectors) // (dims * len(own))]
    return own, np.frombuffer(vectors, kind).reshape(len(own), dims).astype(np.int64)


class SortedLists:
    """A block of candidates with its per-dimension lists."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")  # equal scores then go to the smaller id
        self.ids, self.vectors = ids[order], vectors[order]
        self.largest = np.abs(self.vectors).max(axis=0)
        self.rising = np.argsort(self.vectors, axis=0, kind="stable").astype(np.int32)
        self.values = np.take_along_axis(self.vectors, self.rising, axis=0)
        self.exact = self.vectors.astype(np.float64)

    def top(self, query: np.ndarray, own_id: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best but the query itself, best first, equal scores by id."""
        n = len(self.ids)
        reach = float((np.abs(query).astype(np.float64) * self.largest).sum())
        if reach >= EXACT_IN_LONG:
            return self._top_of_large(query, own_id, k)
        if reach < EXACT_IN_DOUBLE:
            score = lambda rows: (self.exact[rows] @ query.astype(np.float64)).astype(np.int64)
        else:
            score = lambda rows: self.vectors[rows] @ query
        up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        seen = np.zeros(n, np.bool_)
        rows, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        read, depth = 0, FIRST_DEPTH
        while True:
            depth = min(depth, n)
            if not len(up) and not len(down):
                depth = n
            # Half a block seen costs more to look up than to score the rest of it.
            if depth * (len(up) + len(down)) > 4 * n or depth == n:
                new = np.flatnonzero(~seen)
                depth = n
            else:
                fresh = np.zeros(n, np.bool_)
                fresh[self.rising[n - depth : n - read, up].ravel()] = True
                fresh[self.rising[read:depth, down].ravel()] = True
                new = np.flatnonzero(fresh & ~seen)
            seen[new] = True
            new = new[self.ids[new] != own_id]
            rows, scores = np.concatenate((rows, new)), np.concatenate((scores, score(new)))
            if len(rows) > k:
                kth = np.partition(scores, len(scores) - k)[len(scores) - k]
                stay = scores >= kth
                rows, scores = rows[stay], scores[stay]
                if depth < n:
                    bound = int(self.values[n - depth, up] @ query[up]) + int(self.values[depth - 1, down] @ query[down])
                    if bound < kth:
                        break
            if depth == n:
                break
            read, depth = depth, 2 * depth
        best = np.lexsort((self.ids[rows], -scores))[:k]
        return self.ids[rows[best]], scores[best]

    def _top_of_large(self, query: np.ndarray, own_id: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The same where sums may leave a long: those rows are scored with whole numbers of any size."""
        small = np.abs(self.exact) @ np.abs(query.astype(np.float64)) < EXACT_IN_LONG
        scores = np.zeros(len(self.ids), np.int64)
        scores[small] = self.vectors[small] @ query
        fits, asked = small.copy(), query.tolist()
        for row in np.flatnonzero(~small):
            score = sum(a * b for a, b in zip(asked, self.vectors[row].tolist(), strict=True))
            if -(2**63) <= score < 2**63:
                scores[row], fits[row] = score, True
        rows = np.flatnonzero(fits & (self.ids != own_id))
        rows = rows[np.lexsort((self.ids[rows], ~scores[rows]))[:k]]  # ~x falls as x rises, and never overflows
        return self.ids[rows], scores[rows]


def nearest(vectors: DataFrame, queries: Column, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer inner products of every query row.

    ``queries`` tells which rows of ``vectors`` (vec_id, embedding) ask; candidates
    are all rows of the same dimension but those with the query's own id. Equal
    scores rank by vec_id. Rows that repeat a vec_id with the same vector are one.
    A pair whose score fits no long is left out.
    """
    whole = stage(whole_numbers(vectors).dropDuplicates(["vec_id", "whole"]), "vectors")
    blocks = stage(_packs(whole, BLOCK_ROWS), "blocks")
    packs = stage(_packs(whole.where(queries), PACK_ROWS), "packs")
    # Which pack meets which block: a table of small numbers; the vectors follow it.
    plan = packs.select("dims", F.col("unit").alias("pack")).join(blocks.select("dims", F.col("unit").alias("block")), "dims")
    work = (
        plan.join(packs.select("dims", F.col("unit").alias("pack"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors")), ["dims", "pack"])
        .join(blocks.select("dims", F.col("unit").alias("block"), "ids", "vectors"), ["dims", "block"])
        .repartition("dims", "pack", "block")
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lists = SortedLists(*_unpacked(row["ids"], row["vectors"], row["dims"]))
                asked, asking = _unpacked(row["q_ids"], row["q_vectors"], row["dims"])
                q_ids, ids, scores = [], [], []
                for own, query in zip(asked, asking, strict=True):
                    found, score = lists.top(query, int(own), k)
                    q_ids.append(np.full(len(found), own))
                    ids.append(found)
                    scores.append(score)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (q_ids, ids, scores)], ["query_id", "vec_id", "score"])

    best = stage(work.mapInArrow(search, BEST), "best")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    for table in (whole, blocks, packs):
        discard(table)
    return (
        best.distinct().withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
