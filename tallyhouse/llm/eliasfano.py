"""Rising number sequences in few bits, searched without being unpacked.

Every number is split: its low bits lie packed side by side, its high part is the
number of zeros before its one in a bit vector. Counts of ones per block of that
vector give access and successor search to whole arrays of queries at a time. All
parts are plain arrays, so they can lie in a memory-mapped file.
"""

from __future__ import annotations

import mmap
import tempfile

import numpy as np

BLOCK = 8  # 64-bit words between two counts

_ONE = np.uint64(1)
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def mapped(arrays: list[np.ndarray]) -> list[np.ndarray]:
    """The arrays as read-only views of one unlinked file of this task, mapped into memory."""
    sizes = [a.nbytes for a in arrays]
    if not sum(sizes):
        return arrays
    with tempfile.TemporaryFile() as file:
        places = []
        for a in arrays:
            places.append(file.tell())
            file.write(np.ascontiguousarray(a).tobytes())
            file.write(b"\0" * (-file.tell() % 8))
        file.flush()
        view = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
    return [np.frombuffer(view, a.dtype, len(a), at) if len(a) else a for a, at in zip(arrays, places, strict=True)]


def _bits(n: int) -> np.uint64:
    return _ALL >> np.uint64(64 - n) if n else np.uint64(0)


def _packed(values: np.ndarray, width: int) -> np.ndarray:
    """``width`` low bits of every value, side by side, and one spare word."""
    out = np.zeros(len(values) * width // 64 + 2, np.uint64)
    if width and len(values):
        values = values & _bits(width)
        at = np.arange(len(values), dtype=np.int64) * width
        word, off = at >> 6, (at & 63).astype(np.uint64)
        first = np.flatnonzero(np.diff(word, prepend=-1))
        out[word[first]] = np.bitwise_or.reduceat(values << off, first)
        over = np.flatnonzero((at & 63) + width > 64)
        out[word[over] + 1] |= values[over] >> (np.uint64(64) - off[over])
    return out


def _field(packed: np.ndarray, width: int, i: np.ndarray) -> np.ndarray:
    if not width:
        return np.zeros(len(i), np.uint64)
    at = i.astype(np.int64) * width
    word, off = at >> 6, (at & 63).astype(np.uint64)
    rest = (_ONE << np.where(off, np.uint64(64) - off, np.uint64(0))) * (off > 0)  # a shift by 64 has no meaning
    return ((packed[word] >> off) | (packed[word + 1] * rest)) & _bits(width)


def _select_in_word(words: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Place of the one that has ``k`` ones before it."""
    place, k = np.zeros(len(words), np.uint64), k.astype(np.uint64)
    for half in (32, 16, 8, 4, 2, 1):
        below = np.bitwise_count((words >> place) & _bits(half)).astype(np.uint64)
        up = k >= below
        k = np.where(up, k - below, k)
        place = np.where(up, place + np.uint64(half), place)
    return place.astype(np.int64)


class EliasFano:
    """A sequence that never falls."""

    def __init__(self, values: np.ndarray):
        values = np.asarray(values, np.uint64)
        self.n = len(values)
        top = int(values[-1]) + 1 if self.n else 1
        self.width = max(0, (top // max(1, self.n)).bit_length() - 1)
        high = (values >> np.uint64(self.width)).astype(np.int64)
        self.buckets = int(high[-1]) + 1 if self.n else 0
        size = -(-(self.n + self.buckets + 1) // (64 * BLOCK)) * 64 * BLOCK
        ones = np.zeros(size, bool)
        ones[high + np.arange(self.n)] = True
        upper = np.packbits(ones, bitorder="little").view(np.uint64)
        per_block = np.bitwise_count(upper).reshape(-1, BLOCK).sum(axis=1, dtype=np.int64)
        self.parts = [_packed(values, self.width), upper, np.concatenate(([0], np.cumsum(per_block)))]

    def remap(self, parts: list[np.ndarray]) -> None:
        self.parts = parts

    @property
    def nbytes(self) -> int:
        return sum(p.nbytes for p in self.parts)

    def _select(self, k: np.ndarray, zeros: bool) -> np.ndarray:
        """Place in the bit vector of the one (or zero) that has ``k`` of its kind before it."""
        _, upper, counts = self.parts
        if zeros:
            counts = np.arange(len(counts)) * 64 * BLOCK - counts
        block = np.searchsorted(counts, k, "right") - 1
        left = k - counts[block]
        word, found = block * BLOCK, np.zeros(len(k), bool)
        place = np.zeros(len(k), np.int64)
        for step in range(BLOCK):
            bits = upper[word + step]
            bits = ~bits if zeros else bits
            many = np.bitwise_count(bits).astype(np.int64)
            here = ~found & (left < many)
            if here.any():
                place[here] = (word[here] + step) * 64 + _select_in_word(bits[here], left[here])
                found |= here
            left = np.where(found, left, left - many)
            if found.all():
                break
        return place

    def access(self, i: np.ndarray) -> np.ndarray:
        """The numbers at the given places."""
        i = np.asarray(i, np.int64)
        high = (self._select(i, zeros=False) - i).astype(np.uint64)
        return (high << np.uint64(self.width)) | _field(self.parts[0], self.width, i)

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of the first number that is not below ``x`` (the length, if none), and whether it equals ``x``."""
        x = np.asarray(x, np.uint64)
        if not self.n:
            return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
        high = np.minimum(x >> np.uint64(self.width), np.uint64(self.buckets)).astype(np.int64)
        beyond = high >= self.buckets
        h = np.where(beyond, self.buckets - 1, high)
        before = np.maximum(h - 1, 0)
        begin = np.where(h > 0, self._select(before, zeros=True) - before, 0)
        stop = self._select(h, zeros=True) - h
        low = x & _bits(self.width)
        a, b = begin, stop
        while (open_ := a < b).any():
            middle = (a + b) >> 1
            less = open_ & (_field(self.parts[0], self.width, np.minimum(middle, self.n - 1)) < low)
            a, b = np.where(less, middle + 1, a), np.where(open_ & ~less, middle, b)
        a = np.where(beyond, self.n, a)
        equal = ~beyond & (a < stop)
        equal[equal] = _field(self.parts[0], self.width, a[equal]) == low[equal]
        return a, equal


class Level:
    """One level of a trie: the successors of every context, a code and a count for each.

    Contexts rise; a monotone pointer leads from each to its successors. These rise
    within their context, and are stored on top of the last number of the context
    before, so that the whole level rises too.
    """

    def __init__(self, contexts: np.ndarray, successors: np.ndarray, counts: np.ndarray, codes: np.ndarray):
        """Pairs sorted by context and successor, none of them twice; counts of 1 and more."""
        n = len(contexts)
        first = np.flatnonzero(np.diff(contexts, prepend=contexts[:1] - np.uint64(1))) if n else np.zeros(0, np.int64)
        last = np.append(first[1:], n) - 1 if n else first
        top = successors[last] + _ONE
        base = np.concatenate((np.zeros(1, np.uint64), np.cumsum(top)))[:-1] if n else top
        sizes = np.diff(np.append(first, n))
        self.contexts = EliasFano(contexts[first])
        self.pointers = EliasFano(np.append(first, n))
        self.words = EliasFano(successors + _ONE + np.repeat(base, sizes) if n else successors)
        self.counts = EliasFano(np.concatenate(([0], np.cumsum(counts))).astype(np.uint64))
        self.codes = codes
        # From here on the level lies in a file and only what is looked up is in memory.
        all_ = [*self.contexts.parts, *self.pointers.parts, *self.words.parts, *self.counts.parts, codes]
        views = mapped(all_)
        for k, sequence in enumerate((self.contexts, self.pointers, self.words, self.counts)):
            sequence.remap(views[3 * k : 3 * k + 3])
        self.codes = views[-1]

    def __len__(self) -> int:
        return self.words.n

    @property
    def nbytes(self) -> int:
        return sum(s.nbytes for s in (self.contexts, self.pointers, self.words, self.counts)) + self.codes.nbytes

    def find(self, contexts: np.ndarray, spans: np.ndarray, successors: np.ndarray) -> np.ndarray:
        """Place of every successor, -1 where the level has none; the first ``spans[0]`` belong to the first context, and so on."""
        out = np.full(len(successors), -1, np.int64)
        if not len(self) or not len(out):
            return out
        place, known = self.contexts.successor(contexts)
        place = place[known]
        begin, stop = self.pointers.access(place).astype(np.int64), self.pointers.access(place + 1).astype(np.int64)
        base = np.where(begin > 0, self.words.access(np.maximum(begin - 1, 0)), np.uint64(0))
        own, spans = np.flatnonzero(np.repeat(known, spans)), spans[known]
        at, equal = self.words.successor(np.repeat(base + _ONE, spans) + successors[own])
        hit = equal & (at >= np.repeat(begin, spans)) & (at < np.repeat(stop, spans))
        out[own[hit]] = at[hit]
        return out

    def count(self, places: np.ndarray) -> np.ndarray:
        return (self.counts.access(places + 1) - self.counts.access(places)).astype(np.int64)
