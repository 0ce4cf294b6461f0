"""Phrase collocations against plain counting."""

import random
import re
from collections import Counter, defaultdict

import pytest

from wharfline.llm import collocations

LOWER = {c: c + 32 for c in range(65, 91)}
PIECE, WORD = re.compile(r"[.,;:!?\x0A-\x0D]"), re.compile(r"[^\x20\x09]+")
SCHEMA = "doc_id long, text string, lang string, m int, phrase string, f long, part int, words string, a int, score int"


def plain(rows, longest=3, least=10, covered=50, top=2000):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in PIECE.split((text or "").translate(LOWER)):
            words = WORD.findall(piece)
            n[lang] += len(words)
            for m in range(1, longest + 1):
                for i in range(len(words) - m + 1):
                    f[lang][tuple(words[i : i + m])] += 1
    out = []
    for lang, counts in f.items():
        candidates = {g: a for g, a in counts.items() if len(g) > 1 and a >= least}
        gone = set()
        for g, a in candidates.items():
            for m in range(2, len(g)):
                for i in range(len(g) - m + 1):
                    if 100 * a >= covered * counts[g[i : i + m]]:
                        gone.add(g[i : i + m])
        scored = []
        for g, a in candidates.items():
            if g not in gone:
                cuts = [(10**6 * a * a // (counts[g[:k]] * counts[g[k:]]), k, counts[g[:k]], counts[g[k:]]) for k in range(1, len(g))]
                score, _, left, right = min(cuts)
                scored.append((-score, -a, " ".join(g).encode(), left, right))
        for rank, (score, a, g, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, g.decode(), -a, left, right, n[lang], -score))
    return Counter(out)


def texts():
    rng = random.Random(12)
    vocabulary = [*"abcdefghij", "über", "Éa", "naïve", "x-y", "漢字", "a\x00b", "Z", "z"]
    out = [None, "", " \t", "...", "one", "New York City. " * 30, "new york, city " * 12, "A\x0bB\x0cC\rD\nE " * 15, "a  b\tc " * 25]
    for _ in range(150):
        words = [rng.choices(vocabulary, [2 ** -(k / 3) for k in range(len(vocabulary))])[0] for _ in range(rng.randrange(1, 90))]
        out.append("".join(w + rng.choice([" ", " ", " ", "\t", ". ", ",", "\n"]) for w in words))
    out.append(" ".join(f"w{rng.randrange(60)}" for _ in range(20_000)))
    return out


@pytest.fixture(scope="module")
def rows():
    out = [(i, t, ("en", "de", None, "und", "")[i % 5]) for i, t in enumerate(texts())]
    return [*out, out[5], out[5], (None, "New York City is new", "en"), (None, None, None)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, 3, "y", 4, 5) for r in rows], SCHEMA).repartition(5)


def same(got, want):
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert Counter(map(tuple, got.collect())) == want


def test_agrees_with_plain_counting(spark, rows):
    same(collocations.collocations(frame(spark, rows)), plain(rows))


def test_ranges_and_slices_change_nothing(spark, rows, monkeypatch):
    monkeypatch.setattr(collocations, "RANGE_BYTES", 4000)
    monkeypatch.setattr(collocations, "SLICE_BYTES", 3000)
    docs = frame(spark, rows)
    size = sum(len((t or "").encode()) for _, t, _ in rows)
    sized = docs.select(collocations.language(docs).alias("lang"), "text")
    assert len(collocations.cut_points(sized, size // 4000, 3, size // 6)) > 10
    same(collocations.collocations(docs), plain(rows))


def test_other_lengths_and_limits(spark, rows):
    same(collocations.collocations(frame(spark, rows), longest=2, least=3, top=7), plain(rows, 2, 3, top=7))
    same(collocations.collocations(frame(spark, rows), longest=5, least=4, covered=80), plain(rows, 5, 4, 80))


def test_ties_and_exact_products(spark):
    rows = [(1, "b c. " * 10 + "a d. " * 10, "en")]
    assert [(r.phrase, r.rank, r.score) for r in collocations.collocations(frame(spark, rows)).orderBy("rank").collect()] == [("a d", 1, 10**6), ("b c", 2, 10**6)]
    big = spark.createDataFrame([(123456789012345, 123456789012347, 123456789012999)], "a long, l long, r long")
    got = big.select(collocations._score(big.a, big.l, big.r).alias("s")).first().s
    assert got == 10**6 * 123456789012345**2 // (123456789012347 * 123456789012999)


def test_empty_table(spark):
    same(collocations.collocations(frame(spark, []).limit(0)), Counter())
    same(collocations.collocations(frame(spark, [(1, None, None), (2, " ", "en")])), Counter())
