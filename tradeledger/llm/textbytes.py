"""Words and shingles of many texts at once, as numpy arrays over their UTF-8 bytes.

A word is a maximal run of bytes other than the ASCII white space 0x20 and
0x09-0x0D. Words and shingles are known by 64-bit hashes: a polynomial over
mixed byte values, so a hash depends on content alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Texts are worked on in runs of about this many bytes; one longer text is a run of its own.
RUN_BYTES = 2 << 20
# Runs for steps that take some 40 bytes for each byte of text: they take little, and stay in a cache.
SHORT_RUN = 1 << 18

SHINGLE = 5
_RATIO = 0x9E3779B97F4A7C15
_INVERSE = pow(_RATIO, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_EXACT = mix(np.arange(1, 257, dtype=np.uint64))
_FOLDED = _EXACT.copy()
_FOLDED[ord("A") : ord("Z") + 1] = _EXACT[ord("a") : ord("z") + 1]
_PLACES = mix(np.arange(1001, 1001 + SHINGLE, dtype=np.uint64)) | np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept between calls up to the longest asked for."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(n - 1, 1).bit_length()
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if size <= 8 * RUN_BYTES:
            _powers[base] = have
    return have[:n]


class Words(NamedTuple):
    """Words of a run of texts. Text d has words first[d] .. first[d+1]-1."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    offsets: np.ndarray


def runs(texts: pa.Array | pa.ChunkedArray, limit: int = RUN_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Cut a string column into runs: index of the first text, bytes, and offsets of the texts.

    A null text counts as an empty one.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, places, values = texts.buffers()
    offsets = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        upto = min(upto, len(texts))
        yield at, data[offsets[at] : offsets[upto]], offsets[at : upto + 1] - offsets[at]
        at = upto


def find_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    solid = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty_like(solid)
    before[:1] = False
    before[1:] = solid[:-1]
    after = np.empty_like(solid)
    after[-1:] = False
    after[:-1] = solid[1:]
    start = np.flatnonzero(solid & (~before | edge[:-1]))
    end = np.flatnonzero(solid & (~after | edge[1:])) + 1
    return Words(data, start, end, np.searchsorted(start, offsets), offsets)


def word_hashes(words: Words, fold: bool) -> np.ndarray:
    """A hash for each word; ``fold`` reads A-Z as a-z."""
    values = (_FOLDED if fold else _EXACT)[words.data]
    values *= powers(_RATIO, len(values))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, dtype=np.uint64, out=sums[1:])
    spans = sums[words.end] - sums[words.start]
    spans *= powers(_INVERSE, len(values) + 1)[words.start]
    return mix(spans)


def shingle_hashes(hashes: np.ndarray) -> np.ndarray:
    """Hashes of all 5-word shingles of one text's words, in order, with repeats.

    A text of one to four words has its whole sequence as the only shingle.
    """
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(n, SHINGLE)
    total = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        total += hashes[k : n - width + 1 + k] * _PLACES[k]
    return mix(total)
