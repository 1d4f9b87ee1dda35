"""Hashed word shingles of whole texts, vectorised over slices of a partition."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WHITE = np.zeros(256, bool)
_WHITE[[32, 9, 10, 11, 12, 13]] = True
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_STEP = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values: two rounds of shift and odd multiplication."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def powers(n: int) -> np.ndarray:
    out = np.full(n, _STEP, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words (A-Z lower-cased) of the texts, and where each text's words end."""
    raw = _LOWER[np.frombuffer(b"\n".join(x or b"" for x in texts) + b"\n", np.uint8)]
    inside = ~_WHITE[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    starts = np.flatnonzero(first)
    text_ends = np.cumsum([len(x or b"") + 1 for x in texts])
    ends = np.searchsorted(starts, text_ends)
    if not len(starts):
        return np.zeros(0, np.uint64), ends
    at = np.flatnonzero(inside)
    word = np.cumsum(first[at]) - 1
    place = at - starts[word]
    value = _BYTE[raw[at]] * powers(int(place.max()) + 1)[place]
    return mix(np.add.reduceat(value, np.flatnonzero(place == 0))), ends


def shingle_sets(texts: list[bytes | None], size: int) -> Iterator[np.ndarray]:
    """Per text its distinct shingles of `size` words, as sorted 64-bit hashes; a shorter text is one shingle."""
    words, ends = word_hashes(texts)
    weights = mix(np.arange(1, size + 1, dtype=np.uint64)) | _U(1)
    n = max(0, len(words) - size + 1)
    runs = np.zeros(n, np.uint64)
    for k in range(size):
        runs = mix(runs + words[k : k + n] * weights[k])
    start = 0
    for end in ends.tolist():
        if end - start >= size:
            yield np.unique(runs[start : end - size + 1])
        elif end > start:
            one = np.full(1, end - start, np.uint64)
            for k in range(start, end):
                one = mix(one * weights[0] + words[k])
            yield one
        else:
            yield np.zeros(0, np.uint64)
        start = end


def bytes_of(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()
