"""Words and word shingles of many texts at once, as 64-bit hashes in numpy arrays.

A batch's texts are one byte array. A word's hash is a polynomial of its bytes,
taken from running sums, so no word is ever made a Python object.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Words in a shingle.
WIDTH = 5
#: Bytes of text worked on at once; a longer text is worked on alone.
CHUNK = 2 << 20

_ONE = np.uint64(1)
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on every input bit (splitmix64's last steps)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(p: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, p, np.uint64)
    out[0] = _ONE
    return np.multiply.accumulate(out)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and for each text where its words start in them, with the end at last. A-Z count as a-z."""
    sizes = np.array([len(t) for t in texts], np.int64)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    data = np.frombuffer(b"".join(texts), np.uint8)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    inside = ~_SPACE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[bounds] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | cut[1:-1]
    last[:-1] &= ~inside[1:] | cut[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    power, inverse = _powers(_P, len(data)), _powers(_P_INVERSE, len(data))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((_LOWER[data] + _ONE) * power)])
    words = mix((sums[ends] - sums[starts]) * inverse[starts] ^ (ends - starts).astype(np.uint64))
    return words, np.searchsorted(starts, bounds)


def shingle_lists(texts: list[bytes], width: int = WIDTH) -> list[np.ndarray]:
    """Hashes of each text's shingles in order. A text of fewer words has one, of all of them; one without words none."""
    words, at = word_hashes(texts)
    factor = np.uint64(0xD1B54A32D192ED03)
    n = len(words) - width + 1
    rolled = np.zeros(max(n, 0), np.uint64)
    for k in range(width if n > 0 else 0):
        rolled = rolled * factor + words[k : k + n]
    rolled = mix(rolled)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= width:
            out.append(rolled[a : b - width + 1])
        elif b > a:
            short = np.uint64(b - a)
            for w in words[a:b]:
                short = np.uint64((int(short) * int(factor) + int(w)) & (1 << 64) - 1)
            out.append(mix(np.array([short])))
        else:
            out.append(rolled[:0])
    return out


def chunks(texts: pa.Array, most: int = CHUNK) -> Iterator[list[bytes]]:
    """The UTF-8 of an Arrow array's texts, null ones empty, some at a time: most bytes of them, or one."""
    now, size = [], 0
    for x in texts.cast(pa.large_binary()).to_pylist():
        x = x or b""
        if now and size + len(x) > most:
            yield now
            now, size = [], 0
        now.append(x)
        size += len(x)
    if now:
        yield now


def shingle_sets(texts: pa.Array, width: int = WIDTH) -> Iterator[np.ndarray]:
    """Each text's distinct shingle hashes, sorted."""
    for some in chunks(texts):
        yield from map(np.unique, shingle_lists(some, width))
