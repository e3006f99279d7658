"""Word and shingle hashes of whole texts, computed over the UTF-8 bytes of an Arrow column.

A word's hash is a polynomial over randomised byte values modulo 2**64, read
off one running sum per chunk of texts, so no Python string is made per word.
Chunks bound the memory; a single text is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

WIDTH = 5  # words of a shingle
BEGINNING = 4  # bytes
CHUNK_BYTES = 1 << 20  # texts worked on at a time

_random = np.random.default_rng(20240607)


def _odd(n: int) -> np.ndarray:
    return _random.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_BYTE_VALUES, _PLACES, _BASE = _odd(256), _odd(WIDTH), int(_odd(1)[0])
_LENGTH_SALT = _odd(WIDTH)
_BASE_INVERSE = pow(_BASE, -1, 2**64)

_bytes = np.arange(256)
_upper = (_bytes >= 65) & (_bytes <= 90)
FOLDED = np.where(_upper, _bytes + 32, _bytes).astype(np.uint8)
# Words end at the ASCII blanks \x20 and \x09-\x0D.
BLANK = (_bytes == 0x20) | ((_bytes >= 0x09) & (_bytes <= 0x0D))
# Plain words are runs of ASCII letters and digits and of any code point beyond ASCII.
NOT_PLAIN = ~(((_bytes >= 48) & (_bytes <= 57)) | _upper | ((_bytes >= 97) & (_bytes <= 122)) | (_bytes >= 128))


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed permutation of the 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 65536)
        up, down = np.full(size, _BASE, np.uint64), np.full(size, _BASE_INVERSE, np.uint64)
        up[0] = down[0] = 1
        _powers = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _powers


@dataclass
class Chunk:
    """Some texts: their first row, the hash of every word, and where each text's words begin."""

    first: int
    words: np.ndarray  # uint64, word after word, text after text
    at: np.ndarray  # texts + 1 positions in words
    beginnings: np.ndarray  # hash of each word's first bytes; 0 for a word no longer than these


def _text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; NULL holds no byte."""
    if pa.types.is_large_string(column.type):
        width = np.int64
    else:
        column, width = column.cast(pa.string()), np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def chunks(column: pa.Array, ends_word: np.ndarray = BLANK) -> Iterator[Chunk]:
    """Word hashes of all texts of a column, a bounded number of bytes (one text at least) at a time."""
    if not len(column):
        return
    data, offsets = _text_buffer(column)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, "right")) - 1)
        yield Chunk(first, *_hash_words(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], ends_word))
        first = last


def _hash_words(raw: np.ndarray, edges: np.ndarray, ends_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(raw)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(edges), np.int64), np.zeros(0, np.uint64)
    inside = ~ends_word[raw]
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    inner = edges[(edges > 0) & (edges < n)]  # no word goes on from one text to the next
    begins[inner] = inside[inner]
    stops[inner - 1] = inside[inner - 1]
    start, stop = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    up, down = _powers_to(n)
    running = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[FOLDED[raw]] * up[:n], out=running[1:])
    words = mix((running[stop] - running[start]) * down[start])
    begun = mix((running[np.minimum(start + BEGINNING, n)] - running[start]) * down[start] + _LENGTH_SALT[0])
    return words, np.searchsorted(start, edges), np.where(stop - start > BEGINNING, begun, np.uint64(0))


def shingles(words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every five-word shingle in text order, and where each text's shingles begin.

    A text of one to four words has its whole sequence as its only shingle.
    """
    counts = np.diff(at)
    many = np.where(counts >= WIDTH, counts - WIDTH + 1, (counts > 0).astype(np.int64))
    begin = np.concatenate(([0], np.cumsum(many)))
    out = np.zeros(begin[-1], np.uint64)
    if len(words) >= WIDTH:
        every = sum(words[k : len(words) - WIDTH + 1 + k] * _PLACES[k] for k in range(WIDTH))
        whole = np.repeat(counts >= WIDTH, many)
        position = np.arange(begin[-1]) - np.repeat(begin[:-1], many) + np.repeat(at[:-1], many)
        out[whole] = every[position[whole]]
    for text in np.flatnonzero((counts > 0) & (counts < WIDTH)):
        own = words[at[text] : at[text + 1]]
        out[begin[text]] = np.append(own * _PLACES[: len(own)], _LENGTH_SALT[len(own)]).sum(dtype=np.uint64)
    return mix(out), begin


def distinct_sets(found: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct hashes of every text, one text after another."""
    own = [np.unique(found[a:b]) for a, b in zip(begin[:-1], begin[1:], strict=True)]
    sizes = np.concatenate(([0], np.cumsum([len(x) for x in own], dtype=np.int64)))
    return (np.concatenate(own) if own else np.zeros(0, np.uint64)), sizes
