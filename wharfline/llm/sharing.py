"""Which of its hashes does a document share with others? Answered with one narrow exchange each way.

Documents' hash sets go to fragments of the hash space, one row for each fragment and slice of documents;
a fragment sees every document that has one of its hashes, decides what to send back, and answers by
document. Rows are few and hold packed numbers, so a hundred million hashes are a few thousand rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import mix

#: A document's name: 96 bits.
KEY = np.dtype([("a", "<u8"), ("b", "<u4")])
#: Hashes a task holds before it sends them off.
SLICE_HASHES = 1_000_000

SENT = "part int, keys binary, runs binary, hashes binary"
BACK = "part int, keys binary, runs binary, hashes binary, counts binary"

#: Bytes of text whose hashes make a fragment. Larger executors take more.
FRAGMENT_BYTES = 12 << 20
_BACK = pa.schema([("part", pa.int32()), *((k, pa.binary()) for k in ("keys", "runs", "hashes", "counts"))])

#: Gives (name, set of hashes) of documents; one name may come again.
Sets = Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[np.ndarray, np.ndarray]]]
#: Gets sorted hashes and the name of the document of each; tells which entries go back, and a count for each.
Verdict = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def edges_of(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin, and the end."""
    if not len(values):
        return np.zeros(1, np.int64)
    return np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1], [True])))


def _sender(sets: Sets, parts: int):
    step = np.uint64((1 << 64) // parts + 1)

    def rows(keys: list[np.ndarray], held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        names = np.concatenate(keys)
        flat, own = np.concatenate(held), np.repeat(np.arange(len(held)), [len(s) for s in held])
        part = (flat // step).astype(np.int32)
        order = np.argsort(part, kind="stable")  # within a fragment document by document
        flat, own, part = flat[order], own[order], part[order]
        edges = edges_of(part)
        out: list[list] = [[], [], [], []]
        for a, b in zip(edges[:-1], edges[1:]):
            begins = edges_of(own[a:b])
            owners = own[a:b][begins[:-1]]
            row = (int(part[a]), names[owners].tobytes(), np.diff(begins).astype("<u4").tobytes(), flat[a:b].tobytes())
            for column, value in zip(out, row):
                column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), *(pa.array(x, pa.binary()) for x in out[1:])], ["part", "keys", "runs", "hashes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, held, n, seen = [], [], 0, set()
        for name, own in sets(batches):
            mark = (name.tobytes(), hash(own.tobytes()))
            if len(own) and mark not in seen:
                seen.add(mark)
                keys.append(name)
                held.append(own)
                n += len(own)
            if n >= SLICE_HASHES:
                yield from rows(keys, held)
                keys, held, n, seen = [], [], 0, set()
        if n:
            yield from rows(keys, held)

    return run


def joined(batches: Iterator[pa.RecordBatch], kinds: dict[str, np.dtype | str]) -> dict[str, np.ndarray]:
    """The binary columns of all rows of a partition, end to end."""
    held: dict[str, list[bytes]] = {name: [] for name in kinds}
    for batch in batches:
        for name in kinds:
            held[name] += batch.column(name).to_pylist()
    return {name: np.frombuffer(b"".join(held[name]), kind) for name, kind in kinds.items()}


def _judge(parts: int, verdict: Verdict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = joined(batches, {"keys": KEY, "runs": "<u4", "hashes": "<u8"})
        if not len(x["hashes"]):
            return
        flat, own = x["hashes"], np.repeat(np.arange(len(x["keys"])), x["runs"])
        order = np.argsort(flat, kind="stable")
        flat, own = flat[order], own[order]
        new = np.concatenate(([True], flat[1:] != flat[:-1]))
        many = ~(new & np.append(new[1:], True))  # found once: nothing to tell
        flat, own = flat[many], own[many]
        if not len(flat):
            return
        # a document that came more than once counts once
        keys = x["keys"][own]
        order = np.lexsort((keys["b"], keys["a"], flat))
        flat, keys = flat[order], keys[order]
        first = np.concatenate(([True], (flat[1:] != flat[:-1]) | (keys[1:] != keys[:-1])))
        flat, keys = flat[first], keys[first]
        back, counts = verdict(flat, keys)
        flat, keys, counts = flat[back], keys[back], counts[back]
        to = (mix_name(keys) % np.uint64(parts)).astype(np.int32)
        order = np.lexsort((flat, keys["b"], keys["a"], to))
        flat, keys, counts, to = flat[order], keys[order], counts[order], to[order]
        edges = edges_of(to)
        for a, b in zip(edges[:-1], edges[1:]):
            begins = edges_of(keys[a:b])
            values = (keys[a:b][begins[:-1]].tobytes(), np.diff(begins).astype("<u4").tobytes(), flat[a:b].tobytes(), counts[a:b].astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([int(to[a])], pa.int32()), *(pa.array([v], pa.binary()) for v in values)], ["part", "keys", "runs", "hashes", "counts"])

    return run


def mix_name(keys: np.ndarray) -> np.ndarray:
    return mix(keys["a"] ^ (keys["b"].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))


def shared(docs: DataFrame, sets: Sets, verdict: Verdict, text: str) -> DataFrame:
    """Answers, dealt by document: all rows of a group (part) belong to documents that no other group has.

    text: the column the hashes come from. There are as many fragments as its bytes ask for, each a group of its own,
    so what a task holds at once doesn't grow with the table.
    """
    size = docs.agg(F.sum(F.octet_length(text)).alias("n")).first().n or 0
    parts = max(2, -(-size // FRAGMENT_BYTES))
    sent = docs.mapInArrow(_sender(sets, parts), SENT)
    return sent.groupBy("part").applyInArrow(_as_table(_judge(parts, verdict), _BACK), BACK)


def answered(answers_of: DataFrame, consume, schema: str, arrow: pa.Schema) -> DataFrame:
    """What a function from batches to batches makes of each group of answers."""
    return answers_of.groupBy("part").applyInArrow(_as_table(consume, arrow), schema)


def _as_table(run, schema: pa.Schema):
    def one(rows: pa.Table) -> pa.Table:
        out = pa.Table.from_batches([b.cast(schema) for b in run(iter(rows.to_batches()))], schema)
        pa.default_memory_pool().release_unused()  # a worker process lives on beside later stages
        return out

    return one


def answers(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.void, np.ndarray, np.ndarray]]:
    """(name, hashes, counts) of each document of a partition, by count and hash."""
    x = joined(batches, {"keys": KEY, "runs": "<u4", "hashes": "<u8", "counts": "<u4"})
    keys = np.repeat(x["keys"], x["runs"])
    order = np.lexsort((x["hashes"], x["counts"], keys["b"], keys["a"]))
    keys, flat, counts = keys[order], x["hashes"][order], x["counts"][order]
    edges = edges_of(keys)
    for a, b in zip(edges[:-1], edges[1:]):
        yield keys[a], flat[a:b], counts[a:b]
