"""Periodic runs of words, found with a dictionary of basic factors.

The dictionary names every factor of 1, 2, 4, 8, ... words of a document: two places have the same name exactly if
the same words stand there. The name of a factor of 2 L words is the rank of the pair of names of its halves. For
every length L the places of a name are put in order; a place whose successor starts at most L further on, so that
both lie within 2 L words, proposes their distance as a period. Neighbouring places that propose the same
distance are glued together: places s to e with distance d mean that the words s to e + d + L - 1 repeat
after d words, and no neighbour does. That stretch is the whole run:

- d is its smallest period. A smaller one would divide d, and the factor would have come again before.
- Every run of period q that is at least 2 q words and one factor long is proposed, at each L from q up for which
  a factor and its successor fit in. The same run of several lengths L is one run.

Names found once in a document propose nothing at any greater length, so a level works on what the level before left,
and most documents end after three or four. Names are exact: words are compared by their bytes.

Defined results: a null or empty text has no words, no run and an empty collapsed text; ties don't arise, as a run is told by
start and period; repeated rows give repeated rows; null ids give rows with a null id; extra columns don't matter.
A text is worked on whole, whatever its length; short ones are worked on together, a few megabytes at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import column, word_list
from .words import slices, words_of

#: A run has at least so many words, and its period at least so many times.
LEAST = 6
TIMES = 4

RUN = "struct<start:bigint,length:bigint,period:bigint>"
SCHEMA = f"doc_id long, runs array<{RUN}>, collapsed string"


def _ranks(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each value, and which values are found more than once."""
    _, rank, count = np.unique(values, return_inverse=True, return_counts=True)
    return rank, count[rank] > 1


def factor_runs(codes: np.ndarray, doc: np.ndarray, least: int, times: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of the runs of some documents, laid end to end, by start and period.

    codes: a number for each word, the same for the same word; doc: the document of each word, ascending.
    """
    found: list[np.ndarray] = []
    n = len(codes)
    if not n:
        return (np.zeros(0, np.int64),) * 3
    # names of one document are names of no other
    name, again = _ranks(doc.astype(np.int64) * (int(codes.max()) + 1) + codes)
    place = np.flatnonzero(again)
    name = name[again]
    size = 1
    while len(place):
        order = np.argsort(name, kind="stable")
        at, named = place[order], name[order]
        near = (named[1:] == named[:-1]) & (at[1:] - at[:-1] <= size)
        start, period = at[:-1][near], (at[1:] - at[:-1])[near]
        by_start = np.argsort(start)  # a place has one successor
        start, period = start[by_start], period[by_start]
        if len(start):
            joint = (start[1:] == start[:-1] + 1) & (period[1:] == period[:-1])
            first = np.flatnonzero(np.concatenate(([True], ~joint)))
            last = np.append(first[1:], len(start)) - 1
            length = start[last] - start[first] + period[first] + size
            enough = length >= np.maximum(least, times * period[first])
            found.append(np.stack([start[first], period[first], length], 1)[enough])
        # factors of twice the length: pairs of names that both come again
        where = np.full(n, -1, np.int64)
        where[place] = name
        left = place[place + size < n]
        right = where[left + size]
        left, right = left[right >= 0], right[right >= 0]
        if not len(left):
            break
        # a document's names stay its own, so both halves lie in one document if the words do
        inside = doc[left] == doc[left + size]
        left, right = left[inside], right[inside]
        if not len(left):
            break
        name, again = _ranks(where[left] * n + right)
        place, name = left[again], name[again]
        size *= 2
    if not found:
        return (np.zeros(0, np.int64),) * 3
    runs = np.unique(np.concatenate(found), axis=0)
    return runs[:, 0], runs[:, 2], runs[:, 1]


def _run(least: int, times: int):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))), ("collapsed", pa.large_string())]
    )

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        w = words_of(batch.column("text"), lower=False)
        rows, n = batch.num_rows, len(w.starts)
        doc = np.repeat(np.arange(rows), np.diff(w.first))
        # the words end to end, each with a blank behind it
        length = w.ends - w.starts + 1
        offsets = np.concatenate(([0], np.cumsum(length)))
        shift = np.repeat(w.starts - offsets[:-1], length)
        body = np.append(w.data, np.uint8(0x20))[np.arange(int(offsets[-1])) + shift] if n else np.zeros(0, np.uint8)
        body[offsets[1:] - 1] = 0x20
        words = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(body)])
        codes = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64) if n else np.zeros(0, np.int64)
        start, span, period = factor_runs(codes, doc, least, times)
        # words after the first period of any run
        turn = np.zeros(n + 1, np.int64)
        np.add.at(turn, start + period, 1)
        np.add.at(turn, start + span, -1)
        kept = np.cumsum(turn)[:n] == 0
        text = body[np.repeat(kept, length)]
        ends = np.concatenate(([0], np.cumsum(np.where(kept, length, 0))))[w.first]
        # without the last blank of a text that has words
        some = ends[1:] > ends[:-1]
        whole = np.ones(len(text), bool)
        whole[ends[1:][some] - 1] = False
        text = text[whole]
        ends = ends - np.concatenate(([0], np.cumsum(some)))
        collapsed = pa.Array.from_buffers(pa.large_string(), rows, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(text)])
        of = doc[start] if n else np.zeros(0, np.int64)
        begins = np.searchsorted(of, np.arange(rows + 1)).astype(np.int32)
        values = pa.StructArray.from_arrays([pa.array(start - w.first[of]), pa.array(span), pa.array(period)], ["start", "length", "period"])
        runs = pa.ListArray.from_arrays(pa.array(begins, pa.int32()), values)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), runs, collapsed], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end in slices(batch.column("text")):
                yield one(batch.slice(begin, end - begin))

    return run


def periodic_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """doc_id, runs (start, length, period by start and period) and the collapsed text of every document.

    The collapsed text holds the words that no run contains after its first period, joined by one blank.
    """
    rows = docs.select(column(docs, "doc_id", "long").alias("doc_id"), column(docs, "text", "string").alias("text"))
    return rows.mapInArrow(_run(least, times), SCHEMA)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id, text: a tenth of the documents, chosen by their ids, get a periodic tail; a null id is never chosen."""
    doc_id, text = column(docs, "doc_id", "long"), column(docs, "text", "string")
    mark = F.crc32(doc_id.cast("string").cast("binary"))
    turn = F.floor(mark / 10).cast("long")

    def planted(words: Column) -> Column:
        n = F.greatest(F.size(words).cast("long"), F.lit(1))
        begin = turn % n
        period = 1 + F.floor((n - begin) / (3 + turn % 8)).cast("long")
        return F.transform(words, lambda w, i: F.when(i < begin, w).otherwise(F.element_at(words, (begin + (i - begin) % period + 1).cast("int"))))

    rows = docs.select(doc_id.alias("doc_id"), text.alias("text"), F.when(mark % 10 == 0, word_list(text)).alias("words"))
    again = F.when(F.size("words") > 0, F.concat_ws(" ", planted(F.col("words")))).otherwise(F.col("text"))
    return rows.select("doc_id", again.alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """n_runs, the run of the greatest exact length / period, and digests of all runs and of the collapsed text."""
    none = F.lit(None).cast(RUN)
    # length / period compared by cross products; of equal ones the first by start and period stays
    best = F.aggregate(
        "runs", none, lambda top, r: F.when(top.isNull() | (r["length"] * top["period"] > top["length"] * r["period"]), r).otherwise(top)
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    out = found.withColumn("best", best)
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


#: The same rows for a database: equal words of a document make islands for each distance.
SQL = f"""
WITH marked AS (
  SELECT row_number() OVER () AS d, doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
         xor(list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
           lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))
         ), 4294967295) AS h
  FROM documents
), params AS (
  SELECT *, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a, (h // 10) % 8 AS g8 FROM marked
), docs AS (
  SELECT d, doc_id, n, CASE WHEN a IS NULL THEN w ELSE
    list_transform(range(0, n), lambda i: w[CASE WHEN i < a THEN i + 1 ELSE a + (i - a) % (1 + (n - a) // (3 + g8)) + 1 END]) END AS w
  FROM params
), words AS (
  SELECT d, unnest(range(0, n)) AS i, unnest(w) AS word, n FROM docs
), pairs AS (
  SELECT x.d, x.i, y.i - x.i AS q FROM words AS x JOIN words AS y ON x.d = y.d AND x.word = y.word AND y.i > x.i AND {TIMES} * (y.i - x.i) <= x.n
), islands AS (
  SELECT d, q, i, i - row_number() OVER (PARTITION BY d, q ORDER BY i) AS island FROM pairs
), stretches AS (
  SELECT d, q, min(i) AS s, count(*) + q AS m FROM islands GROUP BY d, q, island HAVING count(*) + q >= greatest({LEAST}, {TIMES} * q)
), runs AS (
  SELECT * FROM stretches AS x WHERE NOT EXISTS (
    SELECT 1 FROM stretches AS y WHERE y.d = x.d AND y.q < x.q AND y.s <= x.s AND y.s + y.m >= x.s + x.m)
), told AS (
  SELECT d, count(*) AS n_runs, string_agg(s || ',' || m || ',' || q || chr(10), '' ORDER BY s, q) AS lines FROM runs GROUP BY d
), best AS (
  SELECT * FROM runs AS x WHERE NOT EXISTS (
    SELECT 1 FROM runs AS y WHERE y.d = x.d AND (y.m::HUGEINT * x.q > x.m::HUGEINT * y.q OR (y.m::HUGEINT * x.q = x.m::HUGEINT * y.q AND (y.s, y.q) < (x.s, x.q))))
), gone AS (
  SELECT DISTINCT d, unnest(range(s + q, s + m)) AS i FROM runs
), kept AS (
  SELECT d, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (d, i) GROUP BY d
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.m AS length, best.q AS period, 1000 * best.m // best.q AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(text, '')) AS collapsed_sha256
FROM docs LEFT JOIN told USING (d) LEFT JOIN best USING (d) LEFT JOIN kept USING (d)
"""
