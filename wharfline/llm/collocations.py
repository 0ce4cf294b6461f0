"""Phrase collocations from sorted count streams.

The layout is that of external language-model estimation: windows of words are counted by sorting, never in a hash table
of phrases, and all counts a phrase needs come from streams in prefix order and in suffix order that are merged.

1.  Every place of a piece gives one window: its word and the next ones, up to the longest phrase. A slice of texts sorts its
    windows and counts equal ones. Sorted, the windows are also in order of their prefixes, so one stream holds the
    counts of all phrase lengths.
2.  The order is cut into ranges at cut points read from a sample of windows. The sample decides only how even
    the ranges are. A range gets a sorted block from each slice, as words of its own, codes and counts, compressed.
3.  A range merges its blocks and reads off the counts of windows and of all their prefixes. What is found less than
    ``least`` times in a range is dropped, unless it stands at either end of the range: such a prefix goes on in the
    neighbouring range, and the parts are added up. A hot word or phrase is thus spread over as many ranges as it fills.
4.  From here on there are only phrases found often enough. Stream by stream, a phrase of m words meets the phrase without
    its last word in prefix order and the one without its first word in suffix order, by sort-merge joins. Each
    brings the counts of its own parts along, so a phrase of m words has the counts of both parts of each cut.
5.  The same two orders give each phrase the greatest count of a longer phrase by one word, to the right and to the left.

Counts are exact integers and scores exact decimals; counts above 10 ** 15 are beyond them.

Defined results: null and empty texts have no words; a null language is ``und``; repeated rows count as often as they are there;
null ids count like others; ties of score and count go by the phrase's UTF-8 bytes; an empty table gives no
phrases; extra columns don't matter. Texts of any length are cut into words whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .grams import counted, decoded, encoded, ranked, word_array
from .tables import column, written
from .words import slices, words_of

#: Characters that end a piece, and those that part words within one.
ENDS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"

LONGEST = 3
LEAST = 10
#: A phrase goes if a longer one has at least so many per cent of its occurrences.
COVERED = 50
TOP = 2000
#: Bytes of text that one task sorts at once, and those whose windows make a range. Larger executors take more of both.
SLICE_BYTES = 8 << 20
RANGE_BYTES = 12 << 20
#: Windows of the sample for each range, and groups in which the first ones of a language are chosen.
SAMPLED = 200
SALTS = 64

BLOCK = "part long, lang string, words binary, codes binary, counts binary"
COUNTS = "lang string, m int, phrase string, f long"

_ENDS = np.zeros(256, bool)
_ENDS[list(ENDS)] = True
_PARTS = _ENDS.copy()
_PARTS[list(BLANKS)] = True


def language(docs: DataFrame) -> Column:
    return F.coalesce(column(docs, "lang", "string"), F.lit("und"))


def text_windows(texts: pa.Array, longest: int) -> tuple[pa.Array, list[np.ndarray], np.ndarray]:
    """Distinct words in order; the codes of every window, 0 where it ends early and 1 + place else; the text of each."""
    w = words_of(texts, lower=True, blank=_PARTS)
    n = len(w.starts)
    row = np.repeat(np.arange(len(texts)), np.diff(w.first))
    vocabulary, code = ranked(word_array(w.data, w.starts, w.ends))
    piece = np.concatenate(([0], np.cumsum(_ENDS[w.data])))[w.starts] + row
    columns = [code + 1]
    for k in range(1, longest):
        nxt = np.zeros(n, np.int32)
        if n > k:
            together = piece[k:] == piece[:-k]
            nxt[:-k][together] = code[k:][together] + 1
        columns.append(nxt)
    return vocabulary, columns, row


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.Array]]:
    """Slices of a batch's texts, each of one language."""
    langs = batch.column("lang").dictionary_encode()
    for code, lang in enumerate(langs.dictionary.to_pylist()):
        texts = batch.column("text").filter(pc.equal(langs.indices, code))
        for begin, end in slices(texts, SLICE_BYTES):
            yield lang, texts.slice(begin, end - begin)


def _sampled(longest: int, step: int):
    """Every so many-th window of a slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, texts in _by_language(batch):
                vocabulary, columns, _ = text_windows(texts, longest)
                picked = np.arange(step // 2, len(columns[0]), step)
                words = vocabulary.to_pylist()
                out = [[words[c[i] - 1] if c[i] else b"" for c in columns] for i in picked.tolist()]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(out), pa.string()), pa.array(out, pa.list_(pa.binary()))], ["lang", "window"])

    return run


def cut_points(rows: DataFrame, ranges: int, longest: int, words: int) -> list[tuple[str, list[bytes]]]:
    """The first window of each range but the first, in order: one row for each range comes to the driver.

    words: about how many there are; the sample holds ``SAMPLED`` windows for each range.
    """
    if ranges < 2:
        return []
    step = max(1, words // (ranges * SAMPLED))
    # of long tables whole documents are left out first, so that few are cut into words at all
    texts = max(1, step // 2000)
    some = rows.filter(F.pmod(F.xxhash64("text"), F.lit(texts)) == 0)
    sample = some.mapInArrow(_sampled(longest, max(1, step // texts)), "lang string, window array<binary>")
    dealt = sample.repartitionByRange(ranges, "lang", "window").withColumn("part", F.spark_partition_id())
    first = dealt.groupBy("part").agg(F.min(F.struct("lang", "window")).alias("w"))
    return sorted((r.w.lang, [bytes(x) for x in r.w.window]) for r in first.collect())[1:]


def _blocks(cuts: list[tuple[str, list[bytes]]], longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, texts in _by_language(batch):
                vocabulary, columns, _ = text_windows(texts, longest)
                if not len(columns[0]):
                    continue
                columns, counts = counted(columns, len(vocabulary) + 1, None)
                words = vocabulary.to_pylist()
                edges = [0, *(_first_from(columns, words, w) for c, w in cuts if c == lang), len(counts)]
                part = sum(c < lang for c, _ in cuts)
                out: dict[str, list] = {k: [] for k in ("part", "lang", "words", "codes", "counts")}
                for k, (i, j) in enumerate(zip(edges[:-1], edges[1:])):
                    if j > i:
                        own = (part + k, lang, *encoded(vocabulary, [c[i:j] for c in columns], counts[i:j]))
                        for held, value in zip(out.values(), own):
                            held.append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out["part"], pa.int64()), pa.array(out["lang"], pa.string()), *(pa.array(out[k], pa.binary()) for k in ("words", "codes", "counts"))],
                    list(out),
                )

    return run


def _first_from(columns: list[np.ndarray], words: list[bytes], window: list[bytes]) -> int:
    """How many of the sorted windows come before this one; a window that ends early comes before its extensions."""
    from bisect import bisect_left

    low, high = 0, len(columns[0])
    for c, w in zip(columns, window):
        # codes are 1 + place; a word that isn't there lies between two codes
        at = bisect_left(words, w)
        code = 0 if not w else at + 1
        begin = low + int(np.searchsorted(c[low:high], code, side="left"))
        if w and not (at < len(words) and words[at] == w):
            return begin
        low, high = begin, low + int(np.searchsorted(c[low:high], code, side="right"))
    return low


def _merged(longest: int, least: int):
    """The counts of the windows of a range and of their prefixes."""
    schema = pa.schema([("lang", pa.string()), ("m", pa.int32()), ("phrase", pa.string()), ("f", pa.int64())])

    def one(lang: str, rows: list[dict]) -> Iterator[pa.Table]:
        blocks = [decoded(r, longest) for r in rows]
        vocabulary, rank = ranked(pa.concat_arrays([b[0] for b in blocks]))
        begin, parts = 0, []
        for words, codes, _ in blocks:
            known = np.append(np.int32(0), rank[begin : begin + len(words)] + 1)
            parts.append([known[c] for c in codes])
            begin += len(words)
        columns = [np.concatenate([p[k] for p in parts]) for k in range(longest)]
        columns, counts = counted(columns, len(vocabulary) + 1, np.concatenate([b[2] for b in blocks]))
        yield pa.table([[lang], pa.array([0], pa.int32()), [""], pa.array([int(counts.sum())], pa.int64())], schema=schema)
        texts = vocabulary.cast(pa.large_string())
        new = np.zeros(len(counts), bool)
        new[0] = True
        for m in range(1, longest + 1):
            new[1:] |= columns[m - 1][1:] != columns[m - 1][:-1]
            first = np.flatnonzero(new)
            f = np.add.reduceat(counts, first)
            often = f >= least
            if m < longest:
                often[[0, -1]] = True  # these may go on in the next range
            first, f = first[often], f[often]
            full = columns[m - 1][first] > 0
            first, f = first[full], f[full]
            phrase = pc.binary_join_element_wise(*(texts.take(pa.array(c[first] - 1)) for c in columns[:m]), pa.scalar(" ", pa.large_string()))
            yield pa.table([pa.array([lang] * len(f), pa.string()), pa.array([m] * len(f), pa.int32()), phrase.cast(pa.string()), pa.array(f, pa.int64())], schema=schema)

    def run(rows: pa.Table) -> pa.Table:
        held: dict[str, list[dict]] = {}
        for r in rows.to_pylist():
            held.setdefault(r["lang"], []).append(r)
        return pa.concat_tables([t for lang, own in held.items() for t in one(lang, own)])

    return run


def phrase_counts(docs: DataFrame, longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """lang, m, phrase, f: all phrases of up to ``longest`` words found at least so often; m = 0 has all words of a language."""
    rows = docs.select(language(docs).alias("lang"), column(docs, "text", "string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    cuts = cut_points(rows, -(-size // RANGE_BYTES), longest, size // 6)
    blocks = rows.mapInArrow(_blocks(cuts, longest), BLOCK)
    merged = blocks.groupBy("part").applyInArrow(_merged(longest, least), COUNTS)
    summed = merged.groupBy("lang", "m", "phrase").agg(F.sum("f").alias("f"))
    return written(summed.filter((F.col("f") >= least) | (F.col("m") == 0)), "phrase-counts")


def phrase_parts(counts: DataFrame, longest: int = LONGEST) -> list[DataFrame]:
    """For each m from 2: lang, phrase, f, left (counts of its first 1 .. m - 1 words), right (those of the rest at each cut)."""
    own = lambda m: counts.filter(F.col("m") == m).select("lang", "phrase", "f")
    nothing = F.array().cast("array<bigint>")
    shorter = own(1).withColumn("left", nothing).withColumn("right", nothing)
    out = []
    for m in range(2, longest + 1):
        phrase = own(m).withColumn("head", F.substring_index("phrase", " ", m - 1)).withColumn("tail", F.substring_index("phrase", " ", 1 - m))
        # prefix order: the phrase without its last word; its parts from the left are those of this one too
        heads = shorter.select("lang", F.col("phrase").alias("head"), F.concat("left", F.array("f")).alias("left"))
        phrase = phrase.hint("merge").join(heads.hint("merge"), ["lang", "head"])
        # suffix order: the phrase without its first word
        tails = shorter.select("lang", F.col("phrase").alias("tail"), F.concat(F.array("f"), "right").alias("right"))
        shorter = phrase.hint("merge").join(tails.hint("merge"), ["lang", "tail"])
        out.append(shorter)
        shorter = shorter.select("lang", "phrase", "f", "left", "right")
    return out


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (left right)), exactly."""
    wide = T.DecimalType(15, 0)
    a, left, right = (c.cast(wide) for c in (a, left, right))
    return F.call_function("div", a * a * F.lit(1_000_000).cast(T.DecimalType(7, 0)), left * right)


def scored_phrases(counts: DataFrame, longest: int = LONGEST, covered: int = COVERED) -> DataFrame:
    """lang, phrase, a, l, r, score of every phrase that no longer one covers. Of equal cuts the first counts."""
    levels = phrase_parts(counts, longest)
    out = None
    for m, level in enumerate(levels, 2):
        cuts = [
            F.struct(_score(F.col("f"), F.col("left")[k], F.col("right")[k]).alias("score"), F.lit(k).alias("k"), F.col("left")[k].alias("l"), F.col("right")[k].alias("r"))
            for k in range(m - 1)
        ]
        scored = level.select("lang", "phrase", F.col("f").alias("a"), (F.least(*cuts) if len(cuts) > 1 else cuts[0]).alias("c"))
        if m < longest:
            above = levels[m - 1]
            for part in ("head", "tail"):
                longer = above.groupBy("lang", F.col(part).alias("phrase")).agg(F.max("f").alias(f"by_{part}"))
                scored = scored.hint("merge").join(longer.hint("merge"), ["lang", "phrase"], "left")
            most = F.greatest(F.coalesce("by_head", F.lit(0)), F.coalesce("by_tail", F.lit(0)))
            scored = scored.filter(100 * most < covered * F.col("a"))
        scored = scored.select("lang", "phrase", "a", F.col("c.l").alias("l"), F.col("c.r").alias("r"), F.col("c.score").alias("score"))
        out = scored if out is None else out.unionByName(scored)
    return out


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, covered: int = COVERED, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first phrases of each language by score, count and phrase.

    a: occurrences; l, r: those of the two parts at the lowest-scoring cut; n: all words of the language.
    """
    counts = phrase_counts(docs, longest, least)
    words = counts.filter("m = 0").select("lang", F.col("f").alias("n"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # first among the phrases of a salt, then among those that are left: a language is no single group
    salted = scored_phrases(counts, longest, covered).withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    some = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= top)
    first = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return first.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


#: The same phrases for a database that holds all documents at once.
SQL = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), lists AS (
  SELECT lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda x: x <> '') AS w FROM pieces
), places AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM lists
), counted AS (
  SELECT lang, m, phrase, count(*) AS f FROM (
    SELECT lang, m, array_to_string(w[i : i + m - 1], ' ') AS phrase
    FROM places, (VALUES (1), (2), (3)) AS lengths(m) WHERE i + m - 1 <= len(w)
  ) GROUP BY ALL
), totals AS (
  SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE m = 1 GROUP BY lang
), candidates AS (
  SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM counted WHERE m > 1 AND f >= {LEAST}
), cuts AS (
  SELECT c.lang, c.phrase, c.m, c.a, k, l.f AS l, r.f AS r,
         (1000000::HUGEINT * c.a * c.a) // (l.f::HUGEINT * r.f) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM candidates) AS c
  JOIN counted AS l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:k], ' ')
  JOIN counted AS r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1 :], ' ')
), lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), covered AS (
  SELECT s.lang, s.phrase FROM candidates AS s
  JOIN (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase FROM candidates WHERE m = 3) AS t
    ON t.lang = s.lang AND t.phrase = s.phrase
  WHERE 100 * t.a >= {COVERED} * s.a
), ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score
  FROM lowest ANTI JOIN covered USING (lang, phrase)
)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= {TOP}
"""
