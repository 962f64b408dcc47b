"""Words of whole texts and their 64-bit hashes, for a batch of documents at once with numpy.

A word is a longest run of bytes other than ``[\\x20\\x09-\\x0D]``. Its hash is a polynomial over
random byte values modulo 2**64, taken from prefix sums, then mixed. Two given different words have
the same hash with a probability of about 2**-60.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Bytes that are hashed at a time: the arrays for them take about 40 bytes each.
SEGMENT = 1 << 20
#: Bytes of text in a group of documents.
GROUP = 4 << 20

SPACES = b" \t\n\x0b\x0c\r"
IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every bit depends on all bits (in place where it can)."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> U64(30))
        x *= U64(0xBF58476D1CE4E5B9)
        x ^= x >> U64(27)
        x *= U64(0x94D049BB133111EB)
        x ^= x >> U64(31)
    return x


_BYTE_VALUE = mix((np.arange(1, 257, dtype=U64) * U64(0xD1342543DE82EF95)))
_powers = {_BASE: np.ones(1, U64), _INVERSE: np.ones(1, U64)}


def powers(base: int, n: int) -> np.ndarray:
    """The first n powers modulo 2**64."""
    if len(_powers[base]) < n:
        steps = np.full(max(n, SEGMENT + 4096), base, U64)
        steps[0] = 1
        _powers[base] = np.multiply.accumulate(steps)
    return _powers[base][:n]


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of values[start:end] for each pair; it depends on the values only, not on the place."""
    n = len(values)
    sums = np.zeros(n + 1, U64)
    np.cumsum(values * powers(_BASE, n), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * powers(_INVERSE, n + 1)[starts] + (ends - starts).astype(U64))


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` consecutive words."""
    starts = np.arange(max(0, len(words) - size + 1))
    return range_hashes(words, starts, starts + size)


class Words(NamedTuple):
    """Words of several documents, one after the other."""

    data: np.ndarray  # the documents' bytes, a space after each
    offsets: np.ndarray  # start of each document in data, and the end of the last
    starts: np.ndarray  # of each word in data
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray  # index of each document's first word, and the number of words

    def of(self, i: int) -> slice:
        """The words of document i."""
        return slice(self.first[i], self.first[i + 1])

    def joined(self, kept: np.ndarray, i: int) -> bytes:
        """The chosen words of document i, given as indices, joined by one space."""
        return b" ".join([self.raw[a:b] for a, b in zip(self.starts[kept].tolist(), self.ends[kept].tolist())])

    @property
    def raw(self) -> memoryview:
        return memoryview(self.data)


_IS_LETTER = np.zeros(256, bool)
_IS_LETTER[list(range(65, 91)) + list(range(97, 123))] = True
_IS_MARK = np.zeros(256, bool)
_IS_MARK[list(b'!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~')] = True


def _word_edges(data: np.ndarray, cut: bool) -> tuple[np.ndarray, np.ndarray]:
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~IS_SPACE[data]
    step = np.diff(inside)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    if cut:
        more = np.flatnonzero(_IS_LETTER[data[:-1]] & _IS_MARK[data[1:]]) + 1
        starts, ends = np.sort(np.concatenate([starts, more])), np.sort(np.concatenate([ends, more]))
    return starts, ends


def find_words(texts: list[bytes], lower: bool = False, cut: bool = False) -> Words:
    """Words of the texts; ``lower`` turns A-Z to a-z first, ``cut`` also cuts between an ASCII letter and
    ASCII punctuation other than an apostrophe."""
    whole = b" ".join([*texts, b""])
    if lower:
        whole = whole.lower()  # of bytes: ASCII letters only
    data = np.frombuffer(whole, np.uint8)
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    starts, ends = _word_edges(data, cut)
    hashes = np.empty(len(starts), U64)
    a = 0
    while a < len(starts):  # segments of whole words
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + SEGMENT, "right")))
        low, high = starts[a], ends[b - 1]
        hashes[a:b] = range_hashes(_BYTE_VALUE[data[low:high]], starts[a:b] - low, ends[a:b] - low)
        a = b
    return Words(data, offsets, starts, ends, hashes, np.searchsorted(starts, offsets))


def groups(batch: pa.RecordBatch, column: str, most: int = GROUP) -> Iterator[tuple[int, list[bytes]]]:
    """Texts of a batch in groups of about ``most`` bytes, each with its first row. Null: empty."""
    texts, size, first = [], 0, 0
    values = batch.column(batch.schema.get_field_index(column))
    for value in values.cast(pa.binary()) if len(values) else ():
        text = value.as_py() or b""
        if texts and size + len(text) > most:
            yield first, texts
            texts, size, first = [], 0, first + len(texts)
        texts.append(text)
        size += len(text)
    if texts:
        yield first, texts


def larger(batches: Iterator[pa.RecordBatch], size: int = GROUP) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes: small batches bound the memory for long texts, but
    work on distinct words gains from many texts at once."""
    waiting: list[pa.RecordBatch] = []
    total = 0
    for batch in batches:
        waiting.append(batch)
        total += batch.nbytes
        if total >= size:
            yield pa.concat_batches(waiting)
            waiting, total = [], 0
    if waiting:
        yield pa.concat_batches(waiting)


def shingle_sets(words: Words, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each document, sorted, one document after the other, and where each
    begins. A document of fewer words has one shingle: all of them. One without words has none."""
    per_doc = np.diff(words.first)
    grams = gram_hashes(words.hashes, size)
    starts = words.first[:-1]
    counts = np.where(per_doc >= size, per_doc - size + 1, np.minimum(per_doc, 1))
    edges = np.concatenate([[0], np.cumsum(counts)])
    doc = np.repeat(np.arange(len(per_doc)), counts)
    place = np.arange(edges[-1]) - edges[:-1][doc] + starts[doc]
    values = np.empty(edges[-1], U64)
    short = per_doc[doc] < size
    values[~short] = grams[place[~short]]
    if short.any():
        d = doc[short]
        values[short] = range_hashes(words.hashes, starts[d], starts[d] + per_doc[d])
    order = np.lexsort((values, doc))
    values, doc = values[order], doc[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (doc[1:] != doc[:-1])
    values, doc = values[new], doc[new]
    return values, np.searchsorted(doc, np.arange(len(per_doc) + 1))
