"""Word hashing over whole Arrow text columns with numpy, without Python objects per word.

A word's hash is a polynomial over its bytes modulo 2**64, read off a running sum
of the chunk, then mixed. Equal words get equal hashes in every document,
process and run. Two different words collide with probability about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; a longer document makes a chunk of its own.
CHUNK_BYTES = 1 << 20
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_BASE_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (splitmix64's finish)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _byte_values(fold: bool) -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=_U) * _BASE)
    if fold:
        values[65:91] = values[97:123]
    return values


@dataclass(frozen=True)
class WordRule:
    """Which bytes belong to words, and the value of each byte (A-Z as a-z if folded)."""

    in_word: np.ndarray
    values: np.ndarray


def _space_bytes() -> np.ndarray:
    space = np.zeros(256, dtype=bool)
    space[[0x20, *range(0x09, 0x0E)]] = True
    return space


def _alnum_bytes() -> np.ndarray:
    word = np.zeros(256, dtype=bool)
    word[48:58] = word[65:91] = word[97:123] = True
    word[0x80:] = True
    return word


#: Words are runs without ASCII white space; A-Z count as a-z.
SPACED = WordRule(~_space_bytes(), _byte_values(fold=True))
#: Words are runs of ASCII letters and digits and of any non-ASCII bytes; A-Z count as a-z.
ALNUM = WordRule(_alnum_bytes(), _byte_values(fold=True))


@dataclass
class Chunk:
    """Some rows' text as one byte array; row i is data[bounds[i]:bounds[i + 1]]."""

    first: int
    data: np.ndarray
    bounds: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.bounds) - 1


def chunks(text: pa.Array | pa.ChunkedArray, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Cut a string column into chunks of whole rows; a null is an empty text."""
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    if len(text) == 0:
        return
    text = pc.fill_null(text.cast(pa.large_string()), "")
    _, offsets, data = text.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64, count=len(text) + 1, offset=8 * text.offset)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    start = 0
    while start < len(text):
        end = int(np.searchsorted(bounds, bounds[start] + limit, side="right")) - 1
        end = min(max(end, start + 1), len(text))
        part = bounds[start : end + 1]
        yield Chunk(start, raw[part[0] : part[-1]], part - part[0])
        start = end


_powers: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(size, base, dtype=_U)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


@dataclass
class Words:
    """Words of a chunk: byte spans, hashes, and per piece i the words ptr[i]:ptr[i + 1]."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    ptr: np.ndarray


def words(data: np.ndarray, bounds: np.ndarray, rule: WordRule) -> Words:
    """Words of the pieces data[bounds[i]:bounds[i + 1]] that tile ``data``."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(0, _U), np.zeros(len(bounds), np.int64))
    inside = rule.in_word[data]
    cut = np.zeros(n + 1, dtype=bool)
    cut[bounds] = True
    cut[0] = cut[n] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | cut[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | cut[1:n]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    power, inverse = _power_tables(n)
    total = np.zeros(n + 1, dtype=_U)
    np.cumsum(rule.values[data] * power, out=total[1:])
    hashes = mix((total[end] - total[start]) * inverse[start])
    return Words(start, end, hashes, np.searchsorted(start, bounds))


def combine(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-word windows that start at each word (the last n - 1 words start none)."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, _U)
    factors = mix(np.arange(1, n + 1, dtype=_U)) | _U(1)
    total = hashes[:count] * factors[0]
    for k in range(1, n):
        total += hashes[k : k + count] * factors[k]
    return mix(total)


def hash_word(word: str, rule: WordRule = ALNUM) -> int:
    """The hash of one word as a signed 64-bit integer."""
    raw = np.frombuffer(word.encode(), dtype=np.uint8)
    power, _ = _power_tables(max(1, len(raw)))
    total = np.array([(rule.values[raw] * power[: len(raw)]).sum(dtype=_U)], dtype=_U)
    return int(mix(total).view(np.int64)[0])
