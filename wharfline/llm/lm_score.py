"""Scoring texts with a backoff n-gram model, as a weighted automaton.

The model. Words of a document stand between a start mark and an end, which is a token like others. Of T training
tokens, n1 of them found once, a known word has probability c / (T + n1 + 1), and all unknown words together
(n1 + 1) / (T + n1 + 1): unknown words are one event, as in the base score. After a context h found c(h) times,

    P(w | h) = (c(h w) + PRIOR * P(w | h')) / (c(h) + PRIOR),    h' = h without its first word,

which adds up to one over all events. As an automaton, every context found in training is a state. A state has an arc for each
word that followed it, which weighs log10 P(w | h) and leads to the longest known end of h w, and a failure arc to h',
which weighs log10(PRIOR / (c(h) + PRIOR)) and reads nothing. The root has an arc for every word, also unknown ones.
One walk over a text, from left to right, carries the state and adds up weights: an arc if there is one, else failure arcs until there is.
A state is told by how many of the words before it spans: the longest n-gram that ends there and was found. So the walk
of all texts of a slice is a few passes over arrays, one for each length of n-grams, without a lookup by words.

The work. No table of the model is broadcast or held whole anywhere; what moves grows with the corpus.

1.  Documents are dealt to slices by a hash; a slice holds some megabytes of text and is one group.
2.  A slice sorts its n-grams and sends the distinct ones, with their counts in its training documents, to fragments of
    the hash space as packed blocks that carry their own words. However frequent, an n-gram is one entry of each slice.
3.  A fragment adds up equal n-grams, compared by their words, and answers each block with a row of totals.
4.  The slice, met with its answers, builds the states and arcs its own texts can use and walks over each document.

The totals of the base score (T, distinct tokens, tokens found once) come from a first pass over the words of training documents.
It brings three numbers to the driver. What depends on a word alone, like its hash, is worked out once for each slice.

Defined results: null and empty texts have one token, the end; a null id is the empty text, so it is held out; of an empty
training set only the unknown event is left, with probability one; repeated rows train and are scored each; extra columns don't matter.
Texts of any length are read whole; one text lies in one slice, and so do rows of the same id and text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .grams import decoded, encoded, packed_numbers, ranked, unpacked_numbers
from .tables import column
from .words import Words, factors, mix, slices, split_lower, text_bytes

#: Words of the longest n-grams, and the weight of the shorter context beside the counts of the longer one. On held-out
#: texts of 25 MB a prior of 50 gives -3.33 for a token, 8 gives -3.47, 2 gives -3.64, the base score -4.25.
ORDER = 2
PRIOR = 50.0
#: Added to each count by the base score.
ADDED = 0.1
#: Bytes of text in a slice. Larger executors take more.
SLICE_BYTES = 6 << 20

END, START, FIRST = 0, 1, 2

BLOCK = "part long, m int, slice long, words binary, codes binary, counts binary"
NAMES = ["part", "m", "slice", "words", "codes", "counts"]
KINDS = (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
ANSWER = "slice long, m int, part long, totals binary"
SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def held_out(doc_id: Column) -> Column:
    """Rows whose crc32(doc_id as text) mod 10 is 0; a null id is the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 10 == 0


class Grams:
    """The n-grams of some texts, level by level.

    columns[m]: the codes of the distinct ones of m + 1 words, dealt by part, in order within a part; part[m]: their parts;
    of[m]: for each place of the sequence which of them starts there, or -1; place[m]: a place where each of them starts.
    """

    def __init__(self, texts: pa.Array, order: int, parts: int) -> None:
        words, first = split_lower(texts)
        rows = len(texts)
        self.vocabulary, code = ranked(words)
        row = np.repeat(np.arange(rows), np.diff(first))
        # start, words and end of every document, end to end
        self.first = first + 2 * np.arange(rows + 1)
        self.sequence = np.full(self.first[-1], END, np.int64)
        self.sequence[self.first[:-1]] = START
        self.sequence[np.arange(len(code)) + 2 * row + 1] = code + FIRST
        self.doc = np.repeat(np.arange(rows), np.diff(self.first))
        self.base = len(self.vocabulary) + FIRST
        named = _names(self.vocabulary)
        self.columns: list[list[np.ndarray]] = []
        self.part: list[np.ndarray] = []
        self.of: list[np.ndarray] = []
        self.place: list[np.ndarray] = []
        n = len(self.sequence)
        whole = np.zeros(n, np.int64)  # rank of the n-gram of the level before at each place
        for m in range(1, order + 1):
            place = np.arange(max(n - m + 1, 0))
            place = place[self.doc[place] == self.doc[place + m - 1]]
            if m == 1 and n:  # the codes of single words are dense already
                distinct, inverse = np.empty(self.base, np.int64), self.sequence
                distinct[self.sequence] = place
            else:
                distinct, inverse = _distinct(whole[place] * self.base + self.sequence[place + m - 1])
            whole[place] = inverse
            own = [self.sequence[place[distinct] + k] for k in range(m)]
            name = mix(sum((named[c] * f for c, f in zip(own, factors(m, seed=8))), np.uint64(m)))
            part = (name % np.uint64(parts)).astype(np.int64)
            dealt = np.argsort(part, kind="stable")
            turned = np.empty(len(dealt), np.int64)
            turned[dealt] = np.arange(len(dealt))
            of = np.full(n, -1, np.int64)
            of[place] = turned[inverse]
            self.columns.append([c[dealt] for c in own])
            self.part.append(part[dealt])
            self.of.append(of)
            self.place.append(place[distinct][dealt])


def _names(vocabulary: pa.Array) -> np.ndarray:
    """A hash for each code: start and end, then the words."""
    data, at = text_bytes(vocabulary)
    return np.concatenate((factors(FIRST, seed=7), Words(data[at[0] : at[-1]], at[:-1] - at[0], at[1:] - at[0], at).hashes()))


def _distinct(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct number, in order, and which of them each place has."""
    order = np.argsort(key)
    own = key[order]
    first = np.concatenate(([True], own[1:] != own[:-1]))[: len(own)]
    inverse = np.empty(len(own), np.int64)
    inverse[order] = np.cumsum(first) - 1
    return order[first], inverse


def _edges(part: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1], [True]))) if len(part) else np.zeros(1, np.int64)


def _blocks(grams: Grams, train: np.ndarray, own: int) -> pa.Table:
    """What a slice sends: one block for each level and part, with the counts in training documents."""
    out: dict[str, list] = {k: [] for k in NAMES}
    learns = train[grams.doc]
    for level, (columns, part, of) in enumerate(zip(grams.columns, grams.part, grams.of)):
        counts = np.bincount(of[(of >= 0) & learns], minlength=len(part))
        edges = _edges(part)
        for i, j in zip(edges[:-1], edges[1:]):
            row = (int(part[i]), level + 1, own, *encoded(grams.vocabulary, [c[i:j] for c in columns], counts[i:j], FIRST))
            for held, value in zip(out.values(), row):
                held.append(value)
    return pa.table([pa.array(v, k) for v, k in zip(out.values(), KINDS)], NAMES)


def _sent(order: int, parts: int):
    def run(texts: pa.Table) -> pa.Table:
        texts = texts.combine_chunks()
        own = texts.column("slice")[0].as_py()
        text = _one(texts.column("text"))
        return _blocks(Grams(text, order, parts), _flags(texts), own)

    return run


def _one(texts: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.string())


def _flags(texts: pa.Table) -> np.ndarray:
    return ~_one(texts.column("held_out")).to_numpy(zero_copy_only=False).astype(bool)


def _added(rows: list[dict], m: int) -> Iterator[tuple[dict, np.ndarray, np.ndarray]]:
    """For each block of m-grams: its totals over all blocks, and which n-gram of the fragment each entry is."""
    blocks = [decoded(r, m) for r in rows]
    vocabulary, rank = ranked(pa.concat_arrays([b[0] for b in blocks]))
    begin, parts = 0, []
    for words, codes, _ in blocks:
        known = np.concatenate((np.arange(FIRST), rank[begin : begin + len(words)] + FIRST))
        parts.append([known[c] for c in codes])
        begin += len(words)
    columns = [np.concatenate([p[k] for p in parts]) for k in range(m)]
    whole = columns[0].astype(np.int64)
    for c in columns[1:]:
        whole = _distinct(whole)[1] * (len(vocabulary) + FIRST) + c
    distinct, inverse = _distinct(whole)
    totals = np.bincount(inverse, weights=np.concatenate([b[2] for b in blocks]).astype(np.float64), minlength=len(distinct)).astype(np.int64)
    begin = 0
    for row, (_, codes, _) in zip(rows, blocks):
        own = inverse[begin : begin + len(codes[0])]
        begin += len(codes[0])
        yield row, totals, own


def _answered(rows: pa.Table) -> pa.Table:
    held: dict[int, list[dict]] = {}
    for r in rows.to_pylist():
        held.setdefault(r["m"], []).append(r)
    out = [(r["slice"], m, r["part"], packed_numbers(totals[own])) for m, blocks in held.items() for r, totals, own in _added(blocks, m)]
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary())
    return pa.table([pa.array(v, k) for v, k in zip(zip(*out), kinds)], ["slice", "m", "part", "totals"])


def _summed(rows: pa.Table) -> pa.Table:
    """Training tokens of a fragment, distinct ones and those found once."""
    blocks = rows.to_pylist()
    tokens = distinct = once = 0
    for _, totals, _ in _added(blocks, 1) if blocks else ():
        tokens, distinct, once = int(totals.sum()), len(totals), int((totals == 1).sum())
        break  # the totals come with each block
    return pa.table([pa.array([x], pa.int64()) for x in (tokens, distinct, once)], ["tokens", "distinct", "once"])


def _unigrams(parts: int):
    """Blocks of the training tokens, of slices of a batch: the words, and the end once for each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
            texts = batch.column("text").filter(pa.array(~held))
            for begin, end in slices(texts, SLICE_BYTES):
                vocabulary, code = ranked(split_lower(texts.slice(begin, end - begin))[0])
                counts = np.bincount(code + FIRST, minlength=len(vocabulary) + FIRST)
                counts[END] = end - begin
                part = (mix(_names(vocabulary)) % np.uint64(parts)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                order = order[counts[order] > 0]
                edges = _edges(part[order])
                rows = [(int(part[order[i]]), 1, 0, *encoded(vocabulary, [order[i:j]], counts[order[i:j]], FIRST)) for i, j in zip(edges[:-1], edges[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), KINDS)], NAMES)

    return run


class Automaton:
    """The states and arcs that the n-grams of some texts can use, with their counts in the training documents.

    known[m]: whether the n-gram of m + 1 words was found, so that there is a state for it and an arc by its last word;
    weights[m]: what that arc weighs; backoff[m]: what the failure arc of its state weighs. Single words have an arc from the root, known or not.
    """

    def __init__(self, grams: Grams, counts: list[np.ndarray], tokens: int, once: int, prior: float) -> None:
        self.grams, self.order = grams, len(counts)
        self.known = [c > 0 for c in counts]
        share = np.where(counts[0] > 0, counts[0], once + 1) / (tokens + once + 1)
        self.weights, self.backoff = [np.log10(share)], []
        for level in range(1, self.order):
            # the n-gram without its last word is the state, the one without its first what is left after a failure
            head, rest = grams.of[level - 1][grams.place[level]], grams.of[level - 1][grams.place[level] + 1]
            context = counts[level - 1][head]
            share = np.where(context > 0, (counts[level] + prior * share[rest]) / (context + prior), share[rest])
            self.weights.append(np.log10(share))
            self.backoff.append(np.log10(prior / (counts[level - 1] + prior)))

    def _ending(self, level: int) -> np.ndarray:
        """The n-gram of level + 1 words that ends at each place, or -1."""
        of = self.grams.of[level]
        return of if not level else np.concatenate((np.full(level, -1), of[:-level]))

    def walk(self) -> np.ndarray:
        """log10 probability of each text, from the start mark on."""
        first = self.grams.first
        ending = [self._ending(level) for level in range(self.order)]
        # the state after a place, by its number of words; every end of a found n-gram was found too
        reached = np.zeros(len(self.grams.sequence), np.int8)
        for level, of in enumerate(ending):
            there = np.flatnonzero(of >= 0)
            reached[there[self.known[level][of[there]]]] = level + 1
        state = np.minimum(np.concatenate(([0], reached[:-1])), self.order - 1)
        weight = self.weights[0][ending[0]]
        for level in range(1, self.order):
            at = np.flatnonzero(reached == level + 1)
            weight[at] = self.weights[level][ending[level][at]]
            # no arc of so many words: the state of that many fails
            at = np.flatnonzero((state >= level) & (reached <= level))
            weight[at] += self.backoff[level - 1][ending[level - 1][at - 1]]
        weight[first[:-1]] = 0.0
        return np.add.reduceat(weight, first[:-1])


def _scored(order: int, parts: int, tokens: int, distinct: int, once: int, prior: float):
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return schema.empty_table()
        texts = texts.combine_chunks()
        grams = Grams(_one(texts.column("text")), order, parts)
        held = {(r["m"], r["part"]): r["totals"] for r in answers.to_pylist()}
        counts = []
        for level, part in enumerate(grams.part):
            edges = _edges(part)
            counts.append(np.concatenate([unpacked_numbers(held[level + 1, int(part[i])]) for i in edges[:-1]]))
        first = grams.first
        c = counts[0][grams.of[0]]
        base = np.log10((c + ADDED) / (tokens + ADDED * (distinct + 1)))
        base[first[:-1]] = 0.0
        known = c > 0
        known[first[:-1]] = False
        return pa.table(
            [
                _one(texts.column("doc_id")), _one(texts.column("held_out")), pa.array(np.diff(first) - 1),
                pa.array(np.add.reduceat(known.astype(np.int64), first[:-1])),
                pa.array(np.add.reduceat(base, first[:-1])),
                pa.array(Automaton(grams, counts, tokens, once, prior).walk()),
            ],
            schema=schema,
        )

    return run


def lm_score(docs: DataFrame, order: int = ORDER, prior: float = PRIOR) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    doc_id, text = column(docs, "doc_id", "long"), column(docs, "text", "string")
    rows = docs.select(doc_id.alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"), held_out(doc_id).alias("held_out"))
    size = rows.agg(F.sum(F.octet_length("text") + 1).alias("n")).first().n or 0
    parts = max(1, -(-size // SLICE_BYTES))
    single = rows.mapInArrow(_unigrams(parts), BLOCK).groupBy("part").applyInArrow(_summed, "tokens long, distinct long, once long")
    sums = single.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tokens", "distinct", "once")]).first()
    dealt = rows.withColumn("slice", F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts).cast("long")))
    answers = dealt.groupBy("slice").applyInArrow(_sent(order, parts), BLOCK).groupBy("part").applyInArrow(_answered, ANSWER)
    scored = dealt.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(_scored(order, parts, sums.tokens, sums.distinct, sums.once, prior), SCORED)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(sums.tokens).cast("long").alias("train_tokens"), "base_score", "score")
