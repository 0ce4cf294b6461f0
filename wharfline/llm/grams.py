"""Word n-grams as columns of codes: exact counting by sorting, and packed blocks that carry their own words."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard


def word_array(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Words as a byte-string array, out of their places."""
    length = ends - starts
    offsets = np.concatenate(([0], np.cumsum(length)))
    place = np.arange(int(offsets[-1])) + np.repeat(starts - offsets[:-1], length)
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[place])])


def ranked(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The distinct words in byte order, and the place of each word among them."""
    coded = words.dictionary_encode()
    order = pc.sort_indices(coded.dictionary)
    rank = np.empty(len(order), np.int32)
    rank[order.to_numpy()] = np.arange(len(order), dtype=np.int32)
    return coded.dictionary.take(order), rank[coded.indices.to_numpy(zero_copy_only=False)]


def _key(columns: list[np.ndarray], base: int) -> np.ndarray:
    """One number for each window that orders windows as their words do. Codes are below base."""
    if base ** len(columns) < 2**63:
        key = columns[0].astype(np.int64)
        for c in columns[1:]:
            key *= base
            key += c
        return key
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    for c in columns:
        new[1:] |= c[order][1:] != c[order][:-1]
    key = np.empty(len(order), np.int64)
    key[order] = np.cumsum(new)
    return key


def counted(columns: list[np.ndarray], base: int, counts: np.ndarray | None) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct windows in order, and the sum of the counts of each."""
    key = _key(columns, base)
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    total = np.diff(np.append(first, len(key))) if counts is None else np.add.reduceat(counts[order], first) if len(first) else counts
    return [c[order[first]] for c in columns], total


def joined_words(words: pa.Array) -> bytes:
    """Words with one blank between."""
    if not len(words):
        return b""
    one = pa.LargeListArray.from_arrays(pa.array([0, len(words)], pa.int64()), words.cast(pa.binary()))
    return pc.binary_join(one.cast(pa.list_(pa.binary())), b" ")[0].as_py()


def packed_numbers(values: np.ndarray) -> bytes:
    """Counts byte by byte, compressed."""
    return zstandard.ZstdCompressor(level=3).compress(values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes())


def unpacked_numbers(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1).T
    return np.ascontiguousarray(planes).view("<i8")[:, 0].astype(np.int64)


def encoded(vocabulary: pa.Array, columns: list[np.ndarray], counts: np.ndarray, special: int = 1) -> list[bytes]:
    """A block: the words it uses, the codes column by column and byte by byte, the counts.

    Codes below ``special`` stand for no word, the others for the word at code - special.
    """
    size = len(columns) * len(counts)
    if 16 * size < len(vocabulary):
        used = np.unique(np.concatenate(columns))
        used = used[used >= special]
        codes = np.stack([np.where(c < special, c, np.searchsorted(used, c) + special) for c in columns]).astype("<u4")
    else:
        mark = np.zeros(len(vocabulary) + special, bool)
        for c in columns:
            mark[c] = True
        mark[:special] = False
        used = np.flatnonzero(mark)
        new = np.empty(len(mark), "<u4")
        new[:special], new[used] = np.arange(special), np.arange(special, special + len(used))
        codes = np.stack([new[c] for c in columns])
    words = joined_words(vocabulary.take(pa.array(used - special)))
    codes[0, 1:] -= codes[0, :-1].copy()  # the first word is in order
    planes = np.ascontiguousarray(codes.view(np.uint8).reshape(len(columns), -1, 4).transpose(0, 2, 1))
    packer = zstandard.ZstdCompressor(level=3)
    return [packer.compress(words), packer.compress(planes.tobytes()), packed_numbers(counts)]


def decoded(row: dict, longest: int) -> tuple[pa.Array, list[np.ndarray], np.ndarray]:
    unpacker = zstandard.ZstdDecompressor()
    data = np.frombuffer(unpacker.decompress(row["words"]), np.uint8)
    cut = np.flatnonzero(data == 0x20)
    words = word_array(data, np.concatenate(([0], cut + 1)), np.append(cut, len(data)))
    planes = np.frombuffer(unpacker.decompress(row["codes"]), np.uint8).reshape(longest, 4, -1)
    codes = list(np.ascontiguousarray(planes.transpose(0, 2, 1)).view("<i4")[..., 0])
    codes[0] = np.cumsum(codes[0], dtype=np.int32)
    return words, codes, unpacked_numbers(row["counts"])
