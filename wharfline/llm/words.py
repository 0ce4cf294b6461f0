"""Words and their hashes for whole Arrow batches of texts, in numpy.

A word is a run of bytes other than ``\\x20\\x09-\\x0D``; those bytes never occur inside a longer
UTF-8 character, so cutting bytes cuts characters rightly. Word hashes are multilinear: one random
64-bit factor for each place in the word. They are the same in every task and every run.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
SAME = np.arange(256, dtype=np.uint8)
LOWER = SAME.copy()
LOWER[0x41:0x5B] += 0x20

#: Bytes of text that are held as numpy arrays at once; a longer text makes a slice of its own.
SLICE_BYTES = 2 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def factors(n: int, seed: int = 1) -> np.ndarray:
    """n fixed odd random-looking factors."""
    steps = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix(steps + mix(np.array([seed], dtype=np.uint64))) | np.uint64(1)


_FACTORS = factors(4096)


def _factors(n: int) -> np.ndarray:
    return _FACTORS if n <= len(_FACTORS) else factors(n)


@dataclass
class Words:
    """Words of some texts. first[i]:first[i + 1] are those of text i."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        if not len(self.starts):
            return np.zeros(0, dtype=np.uint64)
        length = self.ends - self.starts
        head = np.cumsum(length) - length
        place = np.arange(int(length.sum())) - np.repeat(head, length)
        value = self.data[place + np.repeat(self.starts, length)].astype(np.uint64) + np.uint64(1)
        value *= _factors(int(length.max()))[place]
        return mix(np.add.reduceat(value, head) + length.astype(np.uint64))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array without a copy, and where each text begins and the last ends."""
    texts = texts.fill_null("") if texts.null_count else texts
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    at = np.frombuffer(texts.buffers()[1], dtype=np.int64 if wide else np.int32) if len(texts) else np.zeros(1, np.int64)
    at = at[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    held = texts.buffers()[2] if len(texts) else None
    data = np.frombuffer(held, dtype=np.uint8) if held is not None and held.size else np.zeros(0, np.uint8)
    return data, at


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges that hold about that many bytes of text each, at least one row."""
    _, at = text_bytes(texts)
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(at, at[row] + most, side="right")) - 1)
        yield row, min(end, len(texts))
        row = end


def words_of(texts: pa.Array, lower: bool, blank: np.ndarray = SPACE) -> Words:
    """blank: for every byte whether it parts words."""
    data, at = text_bytes(texts)
    data = (LOWER if lower else SAME)[data[at[0] : at[-1]]]
    at = at - at[0]
    solid = ~blank[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[at] = True
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1] | edge[1:-1]
    ends[:-1] &= ~solid[1:] | edge[1:-1]
    starts = np.flatnonzero(begins)
    return Words(data, starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, at))


def split_lower(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts end to end, A-Z lowered, as byte strings; where those of each text begin and the last end."""
    data, at = text_bytes(texts)
    held = [None, pa.py_buffer(at - at[0]), pa.py_buffer(LOWER[data[at[0] : at[-1]]])]
    lists = pc.ascii_split_whitespace(pa.Array.from_buffers(pa.large_string(), len(texts), held))
    words, first = lists.values.cast(pa.large_binary()), lists.offsets.to_numpy().astype(np.int64)
    solid = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0  # blanks at an end of a text leave an empty one
    if solid.all():
        return words, first
    return words.filter(pa.array(solid)), np.concatenate(([0], np.cumsum(solid)))[first]


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash for every run of that many words, by its first word; runs across texts are for the caller to leave out."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for k, factor in enumerate(factors(width, seed=2)):
        out += hashes[k : k + n] * factor
    return mix(out)
