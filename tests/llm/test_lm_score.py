"""Language-model scores against a plain model held in dictionaries, and as a probability."""

import math
import random
import re
import zlib
from collections import Counter

import pytest

from wharfline.llm import lm_score

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}
SCHEMA = "doc_id long, text string, lang string, slice int, part int, m int, held_out string, words int"


def tokens(text):
    return [*WORD.findall((text or "").translate(LOWER)), None]


def out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 == 0


class Plain:
    def __init__(self, rows, order=2, prior=lm_score.PRIOR):
        self.order, self.prior, self.counts = order, prior, Counter()
        for doc_id, text in rows:
            if not out(doc_id):
                line = [0, *tokens(text)]
                for m in range(1, order + 1):
                    for i in range(len(line) - m + 1):
                        self.counts[tuple(line[i : i + m])] += 1
        single = {g: c for g, c in self.counts.items() if len(g) == 1 and g != (0,)}
        self.total, self.distinct = sum(single.values()), len(single)
        self.once = sum(c == 1 for c in single.values())

    def p(self, word, context):
        if not context:
            c = self.counts[word,]
            return (c or self.once + 1) / (self.total + self.once + 1)
        lower = self.p(word, context[1:])
        c = self.counts[tuple(context)]
        return (self.counts[(*context, word)] + self.prior * lower) / (c + self.prior) if c else lower

    def score(self, text):
        line, total = [0], 0.0
        for word in tokens(text):
            total += math.log10(self.p(word, line[1 - self.order :] if self.order > 1 else []))
            line.append(word)
        return total

    def row(self, doc_id, text):
        own = [self.counts[t,] for t in tokens(text)]
        base = sum(math.log10((c + 0.1) / (self.total + 0.1 * (self.distinct + 1))) for c in own)
        return (doc_id, out(doc_id), len(own), sum(c > 0 for c in own), self.total, base, self.score(text))


def rounded(row):
    return tuple(round(x, 7) if isinstance(x, float) else x for x in row)


def same(frame, rows, **options):
    plain = Plain(rows, **options)
    assert frame.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    assert Counter(rounded(r) for r in frame.collect()) == Counter(rounded(plain.row(*r)) for r in rows)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(13)
    texts = [None, "", " \n", "one", "ONE one", "<start> <end> start", "über Über É é", "a " * 40, "x\x00y z"]
    base = [f"w{rng.randrange(40)}" for _ in range(60)]
    for k in range(120):
        texts.append(" ".join(base[rng.randrange(30) :] + [f"r{rng.randrange(500)}" for _ in range(k % 9)]))
    texts.append(" ".join(f"v{int(rng.expovariate(1 / 300))}" for _ in range(15_000)))
    out_ = list(enumerate(texts))
    return [*out_, out_[20], out_[20], (None, "one w1 w2"), (None, None), (-3, "w1 w2 w3 never-seen w4")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "en", 1, 2, 3, "x", 4) for r in rows], SCHEMA).repartition(4)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_agrees_with_plain_model(spark, rows, order):
    same(lm_score.lm_score(frame(spark, rows), order=order), rows, order=order)


def test_slices_change_nothing(spark, rows, monkeypatch):
    monkeypatch.setattr(lm_score, "SLICE_BYTES", 3000)
    same(lm_score.lm_score(frame(spark, rows), prior=2.5), rows, prior=2.5)


def test_no_training_rows_and_empty_table(spark):
    rows = [(k, t) for k, t in zip([k for k in range(200) if out(k)], [None, "a b", "a a a"])]
    got = lm_score.lm_score(frame(spark, rows))
    same(got, rows)
    assert {(r.train_tokens, r.n_known, r.score) for r in got.collect()} == {(0, 0, 0.0)}
    assert lm_score.lm_score(frame(spark, []).limit(0)).collect() == []


def test_model_adds_up_to_one(rows):
    plain = Plain(rows, order=3)
    words = [g[0] for g in plain.counts if len(g) == 1 and g != (0,)] + ["never seen"]
    for context in ([], [0], ["w1"], ["never seen"], ["a", "a"], ["w1", "w2"]):
        assert math.isclose(sum(plain.p(w, context) for w in words), 1.0)


def test_held_out_texts_score_above_base(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [r for r in lm_score.lm_score(docs).collect() if r.held_out]
    assert rows and sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_first_pass_sends_training_words_once_a_slice():
    import pyarrow as pa

    from wharfline.llm.grams import decoded

    rows = [("a B a", False), ("c\x0ba  ", False), (" ", False), ("never sent", True)]
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])], ["text", "held_out"])
    found = Counter()
    for out in lm_score._unigrams(3)(iter([batch])):
        for row in out.to_pylist():
            words, codes, counts = decoded(row, 1)
            names = {lm_score.END: None, **{k + lm_score.FIRST: w.decode() for k, w in enumerate(words.to_pylist())}}
            found.update({names[c]: n for c, n in zip(codes[0].tolist(), counts.tolist())})
    assert found == {"a": 3, "b": 1, "c": 1, None: 3}


def test_words_of_odd_and_sliced_texts():
    import pyarrow as pa

    from wharfline.llm.words import split_lower

    texts = ["no", None, "", "\t\n\x0b\x0c\r ", " ÀÉ É x\x1cy\x85 z Z", "A" * 9 + "\r\nb", "a\x00B c", "  x"]
    for kind in (pa.string(), pa.large_string()):
        words, first = split_lower(pa.array(texts, kind).slice(1))
        got = [[w.decode() for w in words[a:b].to_pylist()] for a, b in zip(first[:-1], first[1:])]
        assert got == [WORD.findall((t or "").translate(LOWER)) for t in texts[1:]]
    assert len(split_lower(pa.array([], pa.string()))[0]) == 0
