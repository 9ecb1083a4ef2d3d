"""Words of many texts at once: places and 64-bit hashes by array operations, no loop over words.

Hash of a word: sum of a fixed random number per byte times a power of an odd constant by place in the
word, mixed. Equal words have equal hashes on every machine and in every run.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
#: Bytes of words that end at ASCII white space.
NO_SPACE = np.ones(256, dtype=bool)
NO_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes of words of ASCII letters, digits and all that is not ASCII.
LETTERS = np.zeros(256, dtype=bool)
LETTERS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _power(size: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < size:
        for place, base in enumerate((_ODD, _INVERSE)):
            steps = np.full(max(size, 1 << 20), base, dtype=np.uint64)
            steps[0] = 1
            _powers[place] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one mix of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one array of bytes, and where each one starts and the last ends; missing ones are empty."""
    values = pc.fill_null(pc.cast(texts, pa.large_string()), "")
    offsets = np.frombuffer(values.buffers()[1], dtype=np.int64)[values.offset : values.offset + len(values) + 1]
    if not len(values) or values.buffers()[2] is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(values) + 1, dtype=np.int64)
    data = np.frombuffer(values.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def pieces(texts: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, pa.Array]]:
    """(first row, rows) of whole texts with about ``most`` bytes together, or of one text that has more."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start, before = 0, 0
    while start < len(texts):
        end = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield start, texts.slice(start, end - start)
        start, before = end, int(ends[end - 1])


@dataclass
class Words:
    data: np.ndarray  # lower-cased bytes of all texts
    starts: np.ndarray  # of each word in ``data``
    ends: np.ndarray
    hashes: np.ndarray
    firsts: np.ndarray  # the first word of each text, and at the end the number of words


def words_of(texts: pa.Array, member: np.ndarray = NO_SPACE) -> Words:
    raw, offsets = text_bytes(texts)
    data = LOWER[raw]
    inside = np.empty(len(data) + 1, dtype=bool)
    inside[:-1], inside[-1] = member[raw], False
    before = np.empty(len(data) + 1, dtype=bool)
    before[0], before[1:] = False, inside[:-1]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    opens = inside & ~before
    opens[edges] = inside[edges]
    closes = before & ~inside
    closes[edges] = before[edges]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes)
    power, inverse = _power(len(data) + 1)
    if len(starts):
        terms = _BYTE[data] * power[: len(data)]
        terms[~inside[:-1]] = 0
        sums = np.add.reduceat(terms, starts) * inverse[starts]
    else:
        sums = np.zeros(0, dtype=np.uint64)
    hashes = mixed(sums + (ends - starts).astype(np.uint64))
    return Words(data, starts, ends, hashes, np.searchsorted(starts, offsets))
