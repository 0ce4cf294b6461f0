"""Periodic runs against a brute-force search over all starts and periods."""

import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from wharfline.llm import periodic_runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, runs int, start int, length string, collapsed string, words string"


def smallest_period(words):
    n = len(words)
    return next(q for q in range(1, n + 1) if all(words[i] == words[i + q] for i in range(n - q)))


def plain_runs(words, least=6, times=4):
    """All stretches that keep a period and can't be extended, with their smallest period."""
    n, found = len(words), set()
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, times * q) and smallest_period(words[i : j + q]) == q:
                found.add((i, j - i + q, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def planted(doc_id, words):
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def plain_row(doc_id, text):
    words = planted(doc_id, WORD.findall(text or ""))
    runs = plain_runs(words)
    top = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    best = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
    return (doc_id, len(runs), *best, sha(lines), sha(kept))


def odd_texts():
    rng = random.Random(11)
    texts = [None, "", " \t\n\x0b", "one", "a a a a a", "a a a a a a", "a b a b a b a b", "a b a b a b a", "é é é é é é é", "x x " * 9]
    texts += ["a " * 50 + "b " * 50, "a b " * 40 + "c d e " * 30, ("a " * 7 + "b ") * 6, ("a a b " * 5 + "c ") * 5, " ".join(f"w{i % 37}" for i in range(700))]
    for letters in (2, 3, 5):
        texts += [" ".join(rng.choice("abcdefgh"[:letters]) for _ in range(rng.randrange(1, 120))) for _ in range(40)]
    for _ in range(40):
        unit = [f"u{rng.randrange(4)}" for _ in range(rng.randrange(1, 30))]
        body = unit * rng.randrange(2, 9) + unit[: rng.randrange(len(unit))]
        texts.append("\n".join([*(f"v{rng.randrange(9)}" for _ in range(rng.randrange(20))), *body, "end"]))
    texts.append(" ".join(f"long{rng.randrange(3000)}" for _ in range(6_000)) + " tail of it" * 12)
    return texts


@pytest.fixture(scope="module")
def rows():
    out = [(i, t) for i, t in enumerate(odd_texts())]
    return [*out, out[11], out[11], (None, "z z z z z z z"), (None, None), (-7, "q r q r q r q r q r")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "en", 1, 2, "x", "y", "z") for r in rows], SCHEMA).repartition(4)


def test_rows_agree_with_brute_force(spark, rows):
    docs = periodic_runs.with_planted_runs(frame(spark, rows))
    got = periodic_runs.run_digests(periodic_runs.periodic_runs(docs))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert Counter(map(tuple, got.collect())) == Counter(plain_row(*r) for r in rows)


def test_planted_tail(spark, rows):
    got = {(r.doc_id, r.text) for r in periodic_runs.with_planted_runs(frame(spark, rows)).collect()}
    chosen = 0
    for doc_id, text in rows:
        words = WORD.findall(text or "")
        if planted(doc_id, words) != words:
            chosen += 1
            assert (doc_id, " ".join(planted(doc_id, words))) in got
    assert chosen > 5


def test_operator_keeps_real_outputs(spark):
    got = periodic_runs.periodic_runs(spark.createDataFrame([(1, "go on on on on on on now")], "doc_id long, text string")).first()
    assert [tuple(r) for r in got.runs] == [(1, 6, 1)] and got.collapsed == "go on now"
    looser = periodic_runs.periodic_runs(spark.createDataFrame([(1, "a b a b c")], "doc_id long, text string"), least=4, times=2).first()
    assert [tuple(r) for r in looser.runs] == [(0, 4, 2)] and looser.collapsed == "a b c"


def test_empty_table(spark):
    none = frame(spark, []).limit(0)
    assert periodic_runs.run_digests(periodic_runs.periodic_runs(periodic_runs.with_planted_runs(none))).collect() == []


def test_runs_of_several_documents_stay_apart():
    codes = np.array([1, 1, 1, 1, 1, 1, 1, 1])
    assert [len(x) for x in periodic_runs.factor_runs(codes, np.repeat([0, 1], 4), 6, 4)] == [0, 0, 0]
    assert [x.tolist() for x in periodic_runs.factor_runs(codes, np.zeros(8, int), 6, 4)] == [[0], [8], [1]]
