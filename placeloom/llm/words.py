"""The distinct words of an Arrow batch of texts, found over their bytes, and lists of strings joined."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at once.
SLICE = 1 << 19
#: Distinct words that a task remembers, twice, and the characters of the longest: beyond it those not seen again since the last time are forgotten, which costs time only.
REMEMBERED, LONGEST = 64_000, 64


class Remembered(dict):
    """word: what `learn` gives for it. Words not known yet are learnt many at a time."""

    def __init__(self, learn: Callable[[list[str]], list[str]]):
        super().__init__()
        self.learn, self.before = learn, {}

    def all_of(self, words: list[str]) -> list[str]:
        out = list(map(self.get, words))
        missing = [i for i, x in enumerate(out) if x is None]
        lacking = []
        for i in missing:
            x = self.before.get(words[i])
            if x is None:
                lacking.append(i)
            out[i] = x
        if lacking:
            for i, x in zip(lacking, self.learn([words[i] for i in lacking]), strict=True):
                out[i] = x
        if len(self) + len(missing) > REMEMBERED:
            self.before = dict(self)
            self.clear()
        for i in missing:
            if len(words[i]) <= LONGEST:
                self[words[i]] = out[i]
        return out


def slices(texts: pa.Array) -> Iterator[pa.Array]:
    """The texts in slices of about SLICE bytes, whose tables are all that a task holds at once."""
    ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False))
    if not len(texts):
        yield texts
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE, side="right")))
        yield texts.slice(at, to - at)
        at = to
    # what the slices took goes back, so that a task that is done does not hold it
    pa.default_memory_pool().release_unused()


def joined(sizes: np.ndarray, values: pa.Array, by: str | bytes) -> pa.Array:
    """The values, so many at a time, joined."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), values), pa.scalar(by, values.type))


def at_blanks(data: np.ndarray) -> np.ndarray:
    """Where bytes of a text have a blank behind anything else."""
    blank = data == 32
    return blank & ~np.r_[False, blank[:-1]]


def between_visible(data: np.ndarray) -> np.ndarray:
    """Where bytes of a text have a blank between two visible ASCII characters."""
    visible = (data > 32) & (data < 127)
    return (data == 32) & np.r_[False, visible[:-1]] & np.r_[visible[1:], False]


def nowhere(data: np.ndarray) -> np.ndarray:
    return np.zeros(len(data), bool)


def distinct(texts: pa.Array, starts: Callable[[np.ndarray], np.ndarray]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of all texts one after another, as a dictionary, and how many each text has.

    A text, of Arrow's large strings without nulls, is one word but where starts(bytes) begins another; an empty one has none.
    """
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[at[0] : at[-1]]
    at = at - at[0]
    begin = starts(data)
    begin[at[:-1][at[:-1] < at[1:]]] = True
    begins = np.flatnonzero(begin)
    words = pa.LargeStringArray.from_buffers(len(begins), pa.py_buffer(np.r_[begins, len(data)]), pa.py_buffer(data)).dictionary_encode()
    return words, np.diff(np.searchsorted(begins, at))
