"""Language-model scoring by an Elias-Fano n-gram trie that is spread over the cluster.

Documents become chunks of word numbers (numbers of the chunk's own word list). One
order of n-grams after the other, every chunk sends its distinct n-grams, each as the
trie node of what comes before plus one word, with their training counts, to the
shard that owns them. A shard adds the counts up, lays its part of that trie level out
in memory-mapped Elias-Fano sequences (``eliasfano.Level``) and looks up every n-gram
it was asked for: contexts by successor search, a monotone pointer to the successors,
and a successor search relative to the context. It answers with the node, its count
and the quantised smoothed probability; the next order goes on from these nodes. So
no task, executor or driver ever holds the model, and a frequent n-gram arrives once
per chunk. What follows a very frequent context is split over shards by the next word.

Smoothing is by a Dirichlet prior: with c the count of an n-gram and C that of its
context, p(w | context) = c / (C + PRIOR) + PRIOR / (C + PRIOR) * p(w | shorter context),
and p(w) = (c + 0.1) / (N + 0.1 (V + 1)). The first part is what the trie keeps, in
steps of a twentieth of a power of ten, rounded down, so that probabilities never add
up to more than one. The first word of a text follows an end.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..workspace import discard, stage
from .eliasfano import Level
from .words import chunks, mix

ORDER = 2  # longest n-grams
PRIOR = 100.0  # occurrences a context needs to count as much as what shorter ones say
STEPS = 20  # of a quantised probability, to a power of ten
CHUNK_TOKENS = 1_500_000
SHARD_TOKENS = 1_000_000  # tokens to a shard, on average
SPLIT = 1_000_000  # a context that occurs more often is split

END = np.uint64(0x5BD1E995_9E3779B9)  # hash of the end; words have hashes of 63 bits as well

CHUNK = "chunk long, doc_id array<long>, held_out array<boolean>, tokens array<long>, every long, learnt long, words long, list binary, counts binary, text binary"
ASKED = "shard int, chunk long, context binary, successors binary, size binary, word binary, count binary"
ANSWER = "chunk long, shard int, known long, node binary, count binary, code binary"
SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def held_out(doc_id: Column) -> Column:
    """A tenth of the ids; a NULL id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 10 == 0


def pack(numbers: np.ndarray) -> bytes:
    """Whole numbers as few bytes: byte by byte of all numbers, compressed."""
    numbers = np.ascontiguousarray(numbers, np.uint64)
    width = max(1, (int(numbers.max(initial=0)).bit_length() + 7) // 8)
    planes = numbers.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()
    return bytes([width]) + len(numbers).to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def unpack(packed: bytes) -> np.ndarray:
    width, n = packed[0], int.from_bytes(packed[1:9], "little")
    out = np.zeros((n, 8), np.uint8)
    if n:
        planes = pa.decompress(packed[9:], decompressed_size=width * n, codec="zstd", asbytes=True)
        out[:, :width] = np.frombuffer(planes, np.uint8).reshape(width, n).T
    return out.reshape(-1).view(np.uint64)


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<boolean>": pa.list_(pa.bool_())}
    fields = [f.split() for f in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], [n for n, _ in fields])


# ---- chunks ------------------------------------------------------------------


def _chunk_row(number: int, parts: list[tuple[np.ndarray, np.ndarray, list, list]]) -> tuple:
    """Words of the chunk's list, the most frequent first; each token is a place in it."""
    tokens, sizes = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    ids, held = [i for p in parts for i in p[2]], [h for p in parts for h in p[3]]
    words, place, many = np.unique(tokens, return_inverse=True, return_counts=True)
    by_count = np.argsort(-many, kind="stable")
    rank = np.empty(len(words), np.int64)
    rank[by_count] = np.arange(len(words))
    text = rank[place]
    learnt = np.repeat(~np.asarray(held, bool), sizes)
    counts = np.bincount(text[learnt], minlength=len(words))
    return number, ids, held, sizes.tolist(), len(tokens), int(learnt.sum()), len(words), pack(words[by_count]), pack(counts), pack(text)


def tokenised(docs: DataFrame, chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """Whole texts as chunks of about so many tokens, one row each; a text is never cut."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, parts, many = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            ids, held = batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist()
            for chunk in chunks(batch.column("text")):
                at = np.asarray(chunk.at, np.int64)
                tokens = np.insert(chunk.words >> np.uint64(1), at[1:], END)
                docs_of = slice(chunk.first, chunk.first + len(at) - 1)
                parts.append((tokens, np.diff(at) + 1, ids[docs_of], held[docs_of]))
                many += len(tokens)
                if many >= chunk_tokens:
                    yield _batch(CHUNK, [_chunk_row(number, parts)])
                    number, parts, many = number + 1, [], 0
        if parts:
            yield _batch(CHUNK, [_chunk_row(number, parts)])

    id_ = F.col("doc_id")
    rows = docs.select(id_.cast("long").alias("doc_id"), held_out(id_).alias("held_out"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(cut, CHUNK)


class Reading:
    """A chunk's tokens and, order after order, what the trie knows about the n-gram that ends at each."""

    def __init__(self, text: bytes, sizes: np.ndarray):
        self.text = unpack(text).astype(np.int64)  # place in the word list, later in the list of n-grams
        self.sizes = sizes
        self.starts = np.cumsum(sizes) - sizes
        self.grams = self.text  # places of the n-grams that end at each token; -1 where no text has it
        self.node = self.count = np.zeros(0, np.uint64)  # of each n-gram; 0 of an unknown one: nodes begin at 1
        self.chance = np.zeros(0)  # of each token

    def words_known(self, node: np.ndarray, count: np.ndarray, learnt: int, distinct: int) -> None:
        self.word_node, self.node, self.count = node, node, count
        self.known = count[self.text] > 0
        self.chance = ((count + 0.1) / (learnt + 0.1 * (distinct + 1)))[self.text]
        self.base = np.log10(self.chance)

    def ask(self, order: int) -> tuple[np.ndarray, ...]:
        """Distinct n-grams of this order that the trie may have: node of the context, its count, and node of the word."""
        before = np.empty_like(self.grams)
        before[1:] = self.grams[:-1]
        # What comes before the first word is an end; longer contexts than that it has none.
        before[self.starts] = self.text[self.sizes[0] - 1] if order == 2 else -1
        node = np.append(self.node, np.uint64(0))  # the last one stands for -1
        possible = np.flatnonzero((node[before] > 0) & (self.word_node[self.text] > 0))
        width = len(self.word_node)
        pairs, place = np.unique(before[possible] * width + self.text[possible], return_inverse=True)
        self.place, self.possible, self.before = place, possible, before
        context, word = pairs // max(1, width), pairs % max(1, width)
        return self.node[context], self.count[context].astype(np.int64), self.word_node[word]

    def learnt_counts(self, learnt: np.ndarray, many: int) -> np.ndarray:
        return np.bincount(self.place[learnt[self.possible]], minlength=many)

    def heard(self, node: np.ndarray, count: np.ndarray, code: np.ndarray) -> None:
        """The answers to what was asked."""
        context_count = np.append(self.count, np.uint64(0))[self.before].astype(np.float64)
        share = np.zeros(len(self.text))
        share[self.possible] = unquantised(code)[self.place]
        self.chance = share + PRIOR / (context_count + PRIOR) * self.chance
        grams = np.full(len(self.text), -1, np.int64)
        grams[self.possible] = self.place
        self.grams, self.node, self.count = grams, node, count


def quantised(share: np.ndarray) -> np.ndarray:
    """1 to 255, rounded down to the next step; 0 is left for what the trie does not have."""
    return np.clip(np.ceil(-np.log10(share) * STEPS - 1e-9) + 1, 1, 255).astype(np.uint8)


def unquantised(code: np.ndarray) -> np.ndarray:
    return np.where(code > 0, 10.0 ** (-(code.astype(np.float64) - 1) / STEPS), 0.0)


# ---- shards ------------------------------------------------------------------


class Shards(NamedTuple):
    many: int
    split: int  # occurrences of a context from which its successors lie in several shards

    def of(self, context: np.ndarray, count: np.ndarray, word: np.ndarray) -> np.ndarray:
        parts = (count // self.split + 1).astype(np.uint64)
        salted = mix(context * np.uint64(0x9E3779B97F4A7C15) + mix(word) % parts)
        return ((salted >> np.uint64(32)) % np.uint64(self.many)).astype(np.int64)


def _questions(context: np.ndarray, count: np.ndarray, word: np.ndarray, shards: Shards) -> tuple[np.ndarray, list[tuple[int, slice]]]:
    """The order n-grams are sent in (shard, context, word), and which part of it goes to which shard."""
    shard = shards.of(context, count, word)
    order = np.lexsort((word, context, shard))
    sorted_ = shard[order]
    first = np.flatnonzero(np.diff(sorted_, prepend=-1))
    stop = np.append(first, len(order))[1:]
    return order, [(int(sorted_[a]), slice(a, b)) for a, b in zip(first, stop, strict=True)]


def _asked(chunk: int, context: np.ndarray, context_count: np.ndarray, word: np.ndarray, count: np.ndarray, shards: Shards) -> Iterator[tuple]:
    order, parts = _questions(context, context_count, word, shards)
    for shard, part in parts:
        own = order[part]
        contexts, first, many = np.unique(context[own], return_index=True, return_counts=True)
        steps = np.diff(contexts, prepend=np.uint64(0))
        yield shard, chunk, pack(steps), pack(many), pack(context_count[own][first]), pack(word[own]), pack(count[own])


def answers(asked: DataFrame, nodes: bool, shards: Shards) -> DataFrame:
    """What the shards know of the n-grams they were asked for, in the order of the questions.

    ``nodes``: a further order goes on from here, so nodes and counts are told too.
    """

    def told(shard: int, rows: list[dict]) -> pa.RecordBatch:
        sizes, own, spans, contexts, totals, words, counts = [], [], [], [], [], [], []
        for row in rows:
            many = unpack(row["successors"]).astype(np.int64)
            own.append(np.cumsum(unpack(row["context"])))
            spans.append(many)
            contexts.append(np.repeat(own[-1], many))
            totals.append(np.repeat(unpack(row["size"]), many))
            words.append(unpack(row["word"]))
            counts.append(unpack(row["count"]).astype(np.int64))
            sizes.append(len(words[-1]))
        context, total, word, count = (np.concatenate(x) for x in (contexts, totals, words, counts))
        learnt = np.flatnonzero(count)
        order = learnt[np.lexsort((word[learnt], context[learnt]))]
        c, w = context[order], word[order]
        first = np.flatnonzero(np.append(True, (c[1:] != c[:-1]) | (w[1:] != w[:-1]))) if len(order) else order
        summed = np.add.reduceat(count[order], first) if len(order) else count[order]
        codes = quantised(summed / (total[order][first] + PRIOR))
        level = Level(c[first], w[first], summed, codes)
        every = level.find(np.concatenate(own), np.concatenate(spans), word)
        out, begin = [], 0
        for row, size in zip(rows, sizes, strict=True):
            place = every[begin : begin + size]
            begin += size
            known = place >= 0
            code, node, many = np.zeros(size, np.uint8), np.zeros(size, np.uint64), np.zeros(size, np.int64)
            code[known] = level.codes[place[known]]
            if nodes:
                node[known] = place[known].astype(np.uint64) * np.uint64(shards.many) + np.uint64(shard + 1)
                many[known] = level.count(place[known])
            out.append((row["chunk"], shard, len(level), pack(node) if nodes else b"", pack(many) if nodes else b"", pack(code)))
        return _batch(ANSWER, out)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if rows and row["shard"] != at:
                    yield told(at, rows)
                    rows = []
                at = row["shard"]
                rows.append(row)
        if rows:
            yield told(at, rows)

    return asked.repartition("shard").sortWithinPartitions("shard", "chunk").mapInArrow(stream, ANSWER)


def _gathered(order: np.ndarray, parts: list[tuple[int, slice]], told: dict[int, dict], nodes: bool) -> tuple[np.ndarray, ...]:
    """Answers of all shards, back in the order of the chunk's own n-grams."""
    node, count, code = np.zeros(len(order), np.uint64), np.zeros(len(order), np.uint64), np.zeros(len(order), np.uint8)
    for shard, part in parts:
        own, row = order[part], told[shard]
        code[own] = unpack(row["code"]).astype(np.uint8)
        if nodes:
            node[own], count[own] = unpack(row["node"]), unpack(row["count"])
    return node, count, code


def _read(chunk: dict, told: list[dict], upto: int, last: int, learnt: int, distinct: int, shards: Shards) -> Reading:
    """The chunk as the trie's levels 1 to ``upto`` see it."""
    sizes = np.asarray(chunk["tokens"], np.int64)
    reading = Reading(chunk["text"], sizes)
    words = unpack(chunk["list"])
    root = np.zeros(len(words), np.uint64)
    for order in range(1, upto + 1):
        own = {row["shard"]: row for row in told if row["order"] == order}
        context, count, word = (root, root.astype(np.int64), words) if order == 1 else reading.ask(order)
        if order == 1:
            # All words have the same context; they are dealt out by themselves.
            where, parts = _questions(words, root.astype(np.int64), root, shards)
            node, many, _ = _gathered(where, parts, own, True)
            reading.words_known(node, many, learnt, distinct)
        else:
            where, parts = _questions(context, count, word, shards)
            reading.heard(*_gathered(where, parts, own, order < last))
    return reading


def _word_questions(chunked: DataFrame, shards: Shards) -> DataFrame:
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words, count = unpack(row["list"]), unpack(row["counts"])
                where, parts = _questions(words, np.zeros(len(words), np.int64), np.zeros(len(words), np.uint64), shards)
                for shard, part in parts:
                    own = where[part]
                    many = pack(np.array([len(own)]))
                    yield _batch(ASKED, [(shard, row["chunk"], pack(np.zeros(1)), many, pack(np.zeros(1)), pack(words[own]), pack(count[own]))])

    return chunked.select("chunk", "list", "counts").mapInArrow(ask, ASKED)


def scored(docs: DataFrame, order: int = ORDER, chunk_tokens: int = CHUNK_TOKENS, shard_tokens: int = SHARD_TOKENS, split: int = SPLIT) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Only doc_id and text are read, so other columns may have any name. A NULL or
    empty text is one end. A NULL id counts as an empty text and is held out. Rows
    that repeat are counted, and scored, each time. Where nothing can be learnt every
    token has the same chance of one: scores are then 0. An empty table gives an empty table.
    """
    chunked = stage(tokenised(docs, chunk_tokens), "chunks")
    totals = chunked.agg(F.sum("every").alias("every"), F.sum("learnt").alias("learnt")).first()
    learnt, shards = int(totals["learnt"] or 0), Shards(int(totals["every"] or 0) // shard_tokens + 1, split)
    told = [stage(answers(_word_questions(chunked, shards), True, shards).withColumn("order", F.lit(1)), "level")]
    distinct = int(told[0].groupBy("shard").agg(F.max("known").alias("known")).agg(F.sum("known")).first()[0] or 0)

    def with_answers(make, schema: str) -> DataFrame:  # noqa: ANN001
        """Each chunk with what it has been told so far, through ``make``."""
        heard = reduce(DataFrame.unionByName, told).drop("known")

        def one(chunk: pa.Table, rows: pa.Table) -> pa.Table:
            made = [make(c, rows.to_pylist()) for c in chunk.to_pylist()]
            return pa.Table.from_batches(made, _batch(schema, []).schema)

        return chunked.drop("counts").groupBy("chunk").cogroup(heard.groupBy("chunk")).applyInArrow(one, schema)

    for k in range(2, order + 1):

        def ask(chunk: dict, rows: list[dict], k: int = k) -> pa.RecordBatch:
            reading = _read(chunk, rows, k - 1, order, learnt, distinct, shards)
            context, count, word = reading.ask(k)
            trained = np.repeat(~np.asarray(chunk["held_out"], bool), reading.sizes)
            mine = reading.learnt_counts(trained, len(context))
            return _batch(ASKED, list(_asked(chunk["chunk"], context, count, word, mine, shards)))

        told.append(stage(answers(with_answers(ask, ASKED), k < order, shards).withColumn("order", F.lit(k)), "level"))

    def score(chunk: dict, rows: list[dict]) -> pa.RecordBatch:
        reading = _read(chunk, rows, order, order, learnt, distinct, shards)
        known, base, full = (np.add.reduceat(x, reading.starts) for x in (reading.known.astype(np.int64), reading.base, np.log10(reading.chance)))
        return _batch(SCORED, list(zip(chunk["doc_id"], chunk["held_out"], chunk["tokens"], known.tolist(), base.tolist(), full.tolist(), strict=True)))

    result = stage(with_answers(score, SCORED), "scores")
    for table in (chunked, *told):
        discard(table)
    return result.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(learnt).cast("long").alias("train_tokens"), "base_score", "score")
