"""Removing repeated passages, found by recompression.

Recompression turns a text into ever fewer symbols: a round first replaces runs of one symbol by a symbol
of their own, then parts all symbols by a hash bit into left and right ones and replaces each left symbol
followed by a right one by a symbol for the pair. Names are hashes of what they stand for, so every task gives the
same run or pair the same name without asking, and the names agree over the whole corpus. A symbol depends on a
small stretch of words only, which is carried along: wherever this stretch occurs, the symbol occurs.

1.  After ``ROUNDS`` rounds the symbols of all documents are compared: a symbol found in one document only proves
    that no window around its stretch is found elsewhere. One exchange of about a quarter of the words tells
    each document which of its symbols are shared.
2.  Windows that hold no such proof are the candidates, a few per cent more than the true repeats. None is missed:
    a window that lies in two documents has the same interior symbols in both.
3.  The candidates are verified: their 50-word hashes meet, and those that also start in a document of a smaller id
    go back to their documents. Every word such a window covers is removed.

Defined results: a null text has no words; texts of fewer than 50 words keep all; rows of one id never remove from
each other; a row with a null id counts as the largest id, so others remove from it and it removes from none;
windows are judged on the input. Extra columns don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sharing import KEY, answered, answers, edges_of, shared
from .tables import column, written
from .words import factors, mix, slices, windows, words_of

WINDOW = 50
ROUNDS = 5
NO_ID = 2**63 - 1
FAR = 1 << 60

ANSWER_SCHEMA = "id long, found binary"
_ANSWERS = pa.schema([("id", pa.int64()), ("found", pa.binary())])
JUDGED_SCHEMA = "doc_id long, id long, n_words long, kept_sha256 string, text string, spans binary"
RESULT_SCHEMA = "doc_id long, n_words long, n_removed long, kept_sha256 string"

_RUN, _LEFT, _RIGHT = factors(3, seed=5)
_SIDES = factors(64, seed=6)


def recompress(symbols: np.ndarray, doc: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbols after some rounds, their documents, and the stretch [low, high) of words each depends on.

    A symbol at a document's edge also depends on the edge; its stretch is endless, so it proves nothing.
    """
    low = np.arange(len(symbols), dtype=np.int64)
    high = low + 1
    for turn in range(rounds):
        if len(symbols) < 2:
            break
        # runs: a run is a symbol with a count; that it ends depends on both neighbours
        begins = np.flatnonzero(np.concatenate(([True], (symbols[1:] != symbols[:-1]) | (doc[1:] != doc[:-1]))))
        count = np.diff(np.append(begins, len(symbols))).astype(np.uint64)
        symbols = np.where(count > 1, mix(symbols[begins] * _RUN + count), symbols[begins])
        low, high = np.minimum.reduceat(low, begins), np.maximum.reduceat(high, begins)
        doc = doc[begins]
        joint = doc[1:] == doc[:-1]
        left_low, right_high = low.copy(), high.copy()
        left_low[1:] = np.where(joint, np.minimum(low[1:], low[:-1]), -FAR)
        left_low[0] = -FAR
        right_high[:-1] = np.where(joint, np.maximum(high[:-1], high[1:]), FAR)
        right_high[-1] = FAR
        low, high = left_low, right_high
        # pairs: left symbols take a right one that follows
        right = (mix(symbols + _SIDES[turn]) >> np.uint64(63)).astype(bool)
        pair = np.zeros(len(symbols), bool)
        pair[:-1] = ~right[:-1] & right[1:] & joint
        second = np.zeros(len(symbols), bool)
        second[1:] = pair[:-1]
        name = symbols.copy()
        at = np.flatnonzero(pair)
        name[at] = mix(symbols[at] * _LEFT + symbols[at + 1] * _RIGHT + np.uint64(turn))
        after_low, after_high = low.copy(), high.copy()
        # a pair, and a left symbol without partner, depend on what follows; a right one on what precedes
        looks = ~right
        looks_on = np.flatnonzero(looks[:-1])
        after_low[looks_on] = np.minimum(low[looks_on], low[looks_on + 1])
        after_high[looks_on] = np.where(joint[looks_on], np.maximum(high[looks_on], high[looks_on + 1]), FAR)
        if looks[-1]:
            after_high[-1] = FAR
        back = np.flatnonzero(right[1:]) + 1
        after_low[back] = np.where(joint[back - 1], np.minimum(low[back], low[back - 1]), -FAR)
        after_high[back] = np.maximum(high[back], high[back - 1])
        if right[0]:
            after_low[0] = -FAR
        keep = ~second
        symbols, doc, low, high = name[keep], doc[keep], after_low[keep], after_high[keep]
    return symbols, doc, low, high


def _cut(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For slices of a batch: its rows, the word hashes and the row of each word."""
    texts = batch.column("text")
    for begin, end in slices(texts):
        words = words_of(texts.slice(begin, end - begin), lower=False)
        yield begin, end, words.hashes(), np.repeat(np.arange(end - begin), np.diff(words.first))


def _names(ids: np.ndarray) -> np.ndarray:
    names = np.zeros(len(ids), KEY)
    names["a"] = ids.astype("<i8").view("<u8")
    return names


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("id").to_numpy()


def _symbol_sets(rounds: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for batch in batches:
            names = _names(_ids(batch))
            for begin, end, hashes, row in _cut(batch):
                long = np.bincount(row, minlength=end - begin) >= window
                hashes, row = hashes[long[row]], row[long[row]]
                symbols, row, low, high = recompress(hashes, row, rounds)
                telling = high - low <= window  # the others prove nothing
                symbols, row = symbols[telling], row[telling]
                edges = edges_of(row)
                for a, b in zip(edges[:-1], edges[1:]):
                    k = begin + int(row[a])
                    yield names[k : k + 1], np.unique(symbols[a:b])

    return run


def in_two_documents(flat: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = edges_of(flat)
    counts = np.repeat(np.diff(edges), np.diff(edges))
    return counts > 1, counts


def after_the_first(flat: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries of all but the smallest id of each hash."""
    edges = edges_of(flat)
    ids = keys["a"].copy().view("<i8")
    first = np.repeat(np.minimum.reduceat(ids, edges[:-1]), np.diff(edges))
    return ids > first, np.ones(len(flat), np.int64)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids, found = [], []
    for name, flat, _ in answers(batches):
        ids.append(int(name["a"].astype("<u8").view("<i8")))
        found.append(np.sort(flat).tobytes())
        if len(ids) >= 2000:
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, pa.binary())], ["id", "found"])
            ids, found = [], []
    if ids:
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, pa.binary())], ["id", "found"])


def _found_in(values: np.ndarray, found: bytes | None) -> np.ndarray:
    if not found:
        return np.zeros(len(values), bool)
    known = np.frombuffer(found, "<u8")
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return known[at] == values


def _sha(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _byte_words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()  # bytes split at exactly the six blanks


def _judged(rounds: int, window: int):
    """Candidate windows of each document as spans of starts; documents without any are done."""
    schema = pa.schema([("doc_id", pa.int64()), ("id", pa.int64()), ("n_words", pa.int64()), ("kept_sha256", pa.string()), ("text", pa.string()), ("spans", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, doc_ids, ids = batch.column("found"), batch.column("doc_id"), batch.column("id")
            texts = batch.column("text")
            for begin, end, hashes, row in _cut(batch):
                out: list[dict] = []
                length = np.bincount(row, minlength=end - begin)
                first = np.cumsum(length) - length
                symbols, of, low, high = recompress(hashes, row, rounds)
                edges = np.searchsorted(of, np.arange(end - begin + 1))
                for k in range(end - begin):
                    n = int(length[k])
                    spans = b""
                    if n >= window:
                        a, b = edges[k], edges[k + 1]
                        alone = ~_found_in(symbols[a:b], found[begin + k].as_py()) & (high[a:b] - low[a:b] <= window)
                        # windows that hold the stretch of a symbol no other document has
                        start = np.maximum(high[a:b][alone] - first[k] - window, 0)
                        stop = low[a:b][alone] - first[k]
                        turn = np.zeros(n + 2, np.int64)
                        np.add.at(turn, start, 1)
                        np.add.at(turn, stop + 1, -1)
                        open_ = np.cumsum(turn)[: n - window + 1] == 0
                        steps = np.diff(np.concatenate(([0], open_.astype(np.int8), [0])))
                        spans = np.stack([np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)], 1).astype("<i4").tobytes()
                    text = texts[begin + k].as_py()
                    out.append(
                        {
                            "doc_id": doc_ids[begin + k].as_py(),
                            "id": ids[begin + k].as_py(),
                            "n_words": n,
                            "kept_sha256": None if spans else _sha(_byte_words(text)),
                            "text": text if spans else None,
                            "spans": spans or None,
                        }
                    )
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def _span_starts(spans: bytes) -> np.ndarray:
    pairs = np.frombuffer(spans, "<i4").reshape(-1, 2)
    return np.concatenate([np.arange(a, b) for a, b in pairs])


def _window_sets(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for batch in batches:
            names, spans = _names(_ids(batch)), batch.column("spans")
            for begin, end, hashes, row in _cut(batch):
                first = np.searchsorted(row, np.arange(end - begin))
                all_windows = windows(hashes, window)
                for k in range(end - begin):
                    starts = _span_starts(spans[begin + k].as_py()) + first[k]
                    yield names[begin + k : begin + k + 1], np.unique(all_windows[starts])

    return run


def _removed(window: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found, spans = batch.column("text"), batch.column("found"), batch.column("spans")
            doc_ids = batch.column("doc_id").to_pylist()
            out: list[dict] = []
            for begin, end, hashes, row in _cut(batch):
                first = np.searchsorted(row, np.arange(end - begin + 1))
                all_windows = windows(hashes, window)
                for k in range(end - begin):
                    n = int(first[k + 1] - first[k])
                    starts = _span_starts(spans[begin + k].as_py())
                    again = starts[_found_in(all_windows[starts + first[k]], found[begin + k].as_py())]
                    turn = np.zeros(n + 1, np.int64)
                    turn[again] += 1
                    turn[again + window] -= 1  # starts differ, so do ends
                    gone = np.cumsum(turn)[:n] > 0
                    words = _byte_words(texts[begin + k].as_py())
                    kept = [w for w, g in zip(words, gone.tolist()) if not g] if gone.any() else words
                    out.append({"doc_id": doc_ids[begin + k], "n_words": n, "n_removed": int(gone.sum()), "kept_sha256": _sha(kept)})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def substring_dedup(docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, n_words, n_removed and the SHA-256 of the kept words of every document."""
    doc_id = column(docs, "doc_id", "long")
    rows = docs.select(
        doc_id.alias("doc_id"), F.coalesce(doc_id, F.lit(NO_ID)).alias("id"), column(docs, "text", "string").alias("text")
    )
    own = answered(shared(rows.select("id", "text"), _symbol_sets(rounds, window), in_two_documents, "text"), _packed, ANSWER_SCHEMA, _ANSWERS)
    judged = rows.join(own, "id", "left").select("doc_id", "id", "text", "found")
    judged = written(judged.mapInArrow(_judged(rounds, window), JUDGED_SCHEMA), "substring-candidates")
    open_ = judged.filter("spans IS NOT NULL").select("doc_id", "id", "text", "spans")
    again = answered(shared(open_.select("id", "text", "spans"), _window_sets(window), after_the_first, "text"), _packed, ANSWER_SCHEMA, _ANSWERS)
    done = open_.join(again, "id", "left").select("doc_id", "text", "spans", "found").mapInArrow(_removed(window), RESULT_SCHEMA)
    rest = judged.filter("spans IS NULL").select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), "kept_sha256")
    return done.unionByName(rest)
