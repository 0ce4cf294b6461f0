"""Packing documents into training sequences along a space-filling curve.

Every document is a hashed bag of words, projected to ``DIMENSIONS`` numbers by random signs; a Hilbert curve through
that space orders the documents, so neighbours on the curve use similar words. A first pass splits the texts into words once, for
the place on the curve and for the ids, and writes both. The documents are range-partitioned by
their place on the curve (with a hash of the id below it, so that a group of copies can be split), sorted and
put one after the other into sequences of ``LENGTH`` tokens. A document is cut where a sequence is full. What is left
at the end of a partition goes into sequences whose lengths are powers of two, which need no padding; so nothing is padded.

Tokenizing works word by word: the tokenizer's rules never reach across blanks, so a word's ids are found once and kept.
What depends on a word alone is worked out for the distinct words of some texts, and taken from there for each of their places.
A special token's name within a text gets the special token's id, as ``encode(text, add_special_tokens=False)`` gives it.

Defined results: a null or empty text is the closing id alone; repeated rows are packed each; a null id is packed with
a null id; an empty table gives no pieces. Extra columns don't matter. Sequence ids are unique, not consecutive.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .tables import column, partitions, written
from .words import LOWER, Words, slices, text_bytes

LENGTH = 2048
CLOSING = 1
DIMENSIONS, BITS = 4, 8
#: Bytes of words and ids that a worker keeps, counting so many for an entry besides its word; the older half goes beyond that.
KEPT_BYTES = 96 << 20
ENTRY = 160
#: Words that are learnt in one call.
TOGETHER = 2000
#: Bytes of text that are split into words at once.
SPLIT_BYTES = 16 << 20
#: Bytes of ASCII letters and the lead byte of U+00C0 to U+00FF are 1, those of ASCII punctuation 2, all others 0. An apostrophe may join letters,
#: and "<" may begin the name of a special token; both keep their word whole.
KIND = np.zeros(256, np.uint8)
KIND[0x21:0x7F] = 2
KIND[0x30:0x3A] = 0
KIND[0x41:0x5B] = KIND[0x61:0x7B] = 1
KIND[[0x27, 0x3C]] = 0
KIND[0xC3] = 1


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """The place on the Hilbert curve of points with unsigned coordinates below 2 ** bits, one row each."""
    x = points.T.astype(np.uint64).copy()
    n = len(x)
    for level in range(bits - 1, 0, -1):
        bit, rest = np.uint64(1 << level), np.uint64((1 << level) - 1)
        for k in range(n):
            high = (x[k] & bit) != 0
            swap = np.where(high, np.uint64(0), (x[0] ^ x[k]) & rest)
            x[0] ^= np.where(high, rest, swap)
            x[k] ^= swap
    for k in range(1, n):  # Gray code
        x[k] ^= x[k - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[n - 1] & np.uint64(1 << level), np.uint64((1 << level) - 1), np.uint64(0))
    x ^= turn
    place = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for k in range(n):
            place = (place << np.uint64(1)) | ((x[k] >> np.uint64(level)) & np.uint64(1))
    return place


class SplitTexts:
    """The words of some texts: first[i]:first[i + 1] are the places of text i, codes[k] is the word at place k.

    A distinct word may be empty, beside blanks at an end of a text. data, starts and ends are the bytes of the distinct words.
    """

    def __init__(self, texts: pa.Array) -> None:
        texts = (texts.fill_null("") if texts.null_count else texts).cast(pa.large_string())
        lists = pc.ascii_split_whitespace(texts)
        self.first = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.values.dictionary_encode()
        self.codes = coded.indices.to_numpy(zero_copy_only=False)
        held, at = text_bytes(coded.dictionary)
        self.data, self.starts, self.ends = held[at[0] : at[-1]], at[:-1] - at[0], at[1:] - at[0]

    def places(self) -> np.ndarray:
        """Each text's place on the curve; texts without words lie at the middle of the space."""
        solid = self.ends > self.starts
        hashes = Words(LOWER[self.data], self.starts[solid], self.ends[solid], np.zeros(0, np.int64)).hashes()
        signs = np.zeros((DIMENSIONS + 1, len(solid)), np.int8)
        for k in range(DIMENSIONS):
            signs[k, solid] = 1 - 2 * ((hashes >> np.uint64(11 * k + 5)) & np.uint64(1)).astype(np.int8)
        signs[DIMENSIONS] = solid
        total = np.zeros((DIMENSIONS + 1, len(self.first) - 1))
        for own, sign in zip(total, signs):
            sums = np.concatenate(([0], np.cumsum(sign[self.codes], dtype=np.int64)))
            own[:] = sums[self.first[1:]] - sums[self.first[:-1]]
        points = (total[:-1] / np.maximum(total[-1], 1)).T
        scaled = np.clip((points * 2 + 1) / 2, 0, 1) * ((1 << BITS) - 1)  # most means lie within a half
        return hilbert(scaled.astype(np.uint64), BITS).astype(np.int64)


class WordIds:
    """The ids of words, found once by the tokenizer and kept while there is room.

    The tokenizer never joins letters across blanks. Of a word that is all Latin-1 letters and ASCII punctuation it doesn't even
    join letters with punctuation, and its case doesn't matter, so such words are cut there and lowered: far fewer differ.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.held: dict[bytes, np.ndarray] = {}
        self.bytes = 0
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.final = np.zeros(max(self.tokenizer.get_vocab().values()) + 1, bool)
        self.final[[i for w, i in self.tokenizer.get_vocab().items() if suffix and w.endswith(suffix)]] = True
        #: The smallest kind of number that holds every id.
        self.kind = np.dtype("<u2" if len(self.final) <= 1 << 16 else "<u4")

    def _learn(self, words: list[bytes], plain: bool) -> None:
        for begin in range(0, len(words), TOGETHER):  # what the tokenizer returns for a word is far larger than its ids
            own = words[begin : begin + TOGETHER]
            self.held.update(zip(own, (plain and self._of_one_line(own)) or self._of_each(own)))
        self.bytes += sum(map(len, words)) + ENTRY * len(words)

    def _of_each(self, words: list[bytes]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
        return [np.array(x.ids, np.uint32).tobytes() for x in found]

    def _of_one_line(self, words: list[bytes]) -> list[bytes] | None:
        """The ids of plain words, encoded as one text: each has one id that may end a word, its last. None if that doesn't hold."""
        ids = np.array(self.tokenizer.encode_batch_fast([b" ".join(words).decode()], add_special_tokens=False)[0].ids, np.uint32)
        edges = np.flatnonzero(self.final[ids]) + 1
        if len(edges) != len(words) or edges[-1] != len(ids):
            return None
        flat, at = ids.tobytes(), (edges * 4).tolist()
        return [flat[i:j] for i, j in zip([0, *at], at)]

    def _make_room(self) -> None:
        """The older half goes when there is too much."""
        if self.bytes > KEPT_BYTES:
            names = list(self.held)
            self.held = {w: self.held[w] for w in names[len(names) // 2 :]}
            self.bytes = sum(map(len, self.held)) + ENTRY * len(self.held)

    def _of_words(self, words: SplitTexts) -> pa.Array:
        """The ids of each distinct word, as bytes."""
        solid = np.flatnonzero(words.ends > words.starts)
        size = np.zeros(len(words.starts) + 1, np.int64)
        if not len(solid):
            return _binary(size, np.zeros(0, np.uint8))
        length = (words.ends - words.starts)[solid]
        head = words.starts[solid]
        owner = np.repeat(np.arange(len(solid)), length)
        own = words.data
        kind = KIND[own]
        latin = np.flatnonzero((own[:-1] == 0xC3) & (own[1:] != 0x97) & (own[1:] != 0xB7)) + 1  # 0xD7, 0xF7 are no letters
        kind[latin] = 1
        plain = np.minimum.reduceat(kind, head) > 0
        inside = plain[owner]
        capital = latin[(own[latin] < 0x9F) & inside[latin]]
        own = np.where(inside, LOWER[own], own)
        own[capital] += 0x20
        cut = np.ones(len(own), bool)
        cut[1:] = (owner[1:] != owner[:-1]) | (inside[1:] & (kind[1:] != kind[:-1]))
        begins = np.flatnonzero(cut)
        pieces = _binary(np.append(begins, len(own)), own)
        coded = pieces.dictionary_encode()
        of = coded.indices.to_numpy(zero_copy_only=False)
        names, at = text_bytes(coded.dictionary)
        names, at = names.tobytes(), at.tolist()
        distinct = [names[i:j] for i, j in zip(at, at[1:])]
        # the same bytes are always of one kind, as their kind is told by them alone
        cuttable = np.zeros(len(distinct), bool)
        cuttable[of] = inside[begins]
        self._make_room()
        held = list(map(self.held.get, distinct))
        new = [k for k, ids in enumerate(held) if ids is None]
        for together in (True, False):
            self._learn([distinct[k] for k in new if cuttable[k] == together], together)
        for k in new:
            held[k] = self.held[distinct[k]]
        ids = _binary(np.concatenate(([0], np.cumsum(np.fromiter(map(len, held), np.int64, len(held))))), np.frombuffer(b"".join(held), np.uint8)).take(pa.array(of))
        flat, at = text_bytes(ids)
        size[solid + 1] = np.diff(at[np.searchsorted(begins, np.append(head, len(own)))])
        return _binary(np.cumsum(size), flat)

    def of(self, words: SplitTexts) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, and where each text begins and the last ends."""
        flat, at = text_bytes(self._of_words(words).take(pa.array(words.codes)))
        return flat.view(np.uint32), (at // 4)[words.first]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return self.of(SplitTexts(texts))


def _binary(at: np.ndarray, data: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data)])


_KEPT: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One for each worker process and file: what earlier tasks learnt is used again."""
    if path not in _KEPT:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on every core already
        _KEPT[path] = WordIds(path)
    return _KEPT[path]


PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class _Writer:
    """Fills sequences of one partition and keeps the finished pieces."""

    def __init__(self, partition: int, with_ids: bool):
        self.next = partition << 32
        self.with_ids = with_ids
        self.open: list[tuple] = []  # (doc_id, start, ids, doc_tokens) of the sequence that is being filled
        self.filled = 0
        self.rows: list[tuple] = []
        self.ids: list[np.ndarray] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        start = 0
        while start < len(ids):
            take = min(LENGTH - self.filled, len(ids) - start)
            self.open.append((doc_id, start, ids[start : start + take], len(ids)))
            self.filled += take
            start += take
            if self.filled == LENGTH:
                self._close(self.open)
                self.open, self.filled = [], 0

    def _close(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, ids, total in pieces:
            crc = zlib.crc32(ids.astype("<u4").tobytes())
            self.rows.append((doc_id, start, len(ids), crc, total, self.next, offset))
            if self.with_ids:
                self.ids.append(ids)
            offset += len(ids)
        self.next += 1

    def finish(self) -> None:
        """The rest, in sequences of powers of two, the largest first."""
        while self.filled:
            size = 1 << (self.filled.bit_length() - 1)
            pieces, room = [], size
            while room:
                doc_id, start, ids, total = self.open.pop(0)
                pieces.append((doc_id, start, ids[:room], total))
                if len(ids) > room:
                    self.open.insert(0, (doc_id, start + room, ids[room:], total))
                room -= len(pieces[-1][2])
            self._close(pieces)
            self.filled -= size

    def batch(self) -> pa.RecordBatch:
        columns = [pa.array(c, pa.int64()) for c in (zip(*self.rows) if self.rows else [[]] * 7)]
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        if self.with_ids:
            edges = np.concatenate(([0], np.cumsum([len(x) for x in self.ids]))).astype(np.int32)
            flat = np.concatenate(self.ids) if self.ids else np.zeros(0, np.int32)
            columns.append(pa.ListArray.from_arrays(pa.array(edges), pa.array(flat.astype(np.int32))))
            names.append("ids")
        self.rows, self.ids = [], []
        return pa.RecordBatch.from_arrays(columns, names)


ENCODED = "doc_id long, place long, ids binary"


def _encoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_ids(path)
        for batch in batches:
            texts = batch.column("text")
            salt = batch.column("salt").to_numpy().astype(np.int64) & ((1 << 31) - 1)
            for begin, end in slices(texts, SPLIT_BYTES):
                words = SplitTexts(texts.slice(begin, end - begin))
                flat, edges = known.of(words)
                ids = _binary(edges * known.kind.itemsize, flat.astype(known.kind).view(np.uint8)).cast(pa.binary())
                place = (words.places() << 31) | salt[begin:end]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(begin, end - begin), pa.array(place), ids], ["doc_id", "place", "ids"])
            pa.default_memory_pool().release_unused()  # a worker process lives on beside later stages

    return run


def _packer(kind: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = _Writer(TaskContext.get().partitionId(), with_ids)
        closing = np.array([CLOSING], np.uint32)
        for batch in batches:
            flat, at = text_bytes(batch.column("ids"))
            for doc_id, i, j in zip(batch.column("doc_id").to_pylist(), at[:-1].tolist(), at[1:].tolist()):
                writer.add(doc_id, np.concatenate([flat[i:j].view(kind), closing]))
                if len(writer.rows) >= 2000:
                    yield writer.batch()
        writer.finish()
        if writer.rows:
            yield writer.batch()

    return run


def pack(docs: DataFrame, path: str | None = None, with_ids: bool = True) -> DataFrame:
    """One row per piece of a document: where it lies in the document and in which sequence; with its ids if asked for."""
    spark = docs.sparkSession
    doc_id = column(docs, "doc_id", "long")
    rows = docs.select(doc_id.alias("doc_id"), column(docs, "text", "string").alias("text"), F.xxhash64(doc_id).alias("salt"))
    path = path or tokenizer_path()
    # written, as dealing by ranges reads its input twice
    encoded = written(rows.mapInArrow(_encoded(path), ENCODED), "packing-ids")
    # between copies of one text the order is by hashed id, then id, then ids
    dealt = encoded.repartitionByRange(partitions(spark), "place").sortWithinPartitions("place", "doc_id", "ids")
    schema = PIECE + (", ids array<int>" if with_ids else "")
    return dealt.select("doc_id", "ids").mapInArrow(_packer(word_ids(path).kind.str, with_ids), schema)
