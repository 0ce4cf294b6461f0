"""The toxicity model is learnt in a task: the driver sees the model, not the sample."""

import random
import tracemalloc
from collections import Counter

import pyarrow as pa

from wharfline.llm import toxicity

from test_llm_operators import prose


def made(n, words):
    rng = random.Random(11)
    return [(i, prose(rng, words, 3000) + (f" horrid{rng.randrange(9)} thing" * 3 if i % 5 == 0 else ""), int(i % 5 == 0)) for i in range(n)]


def test_the_sample_does_not_pass_through_the_driver(spark):
    rows = made(1200, 200)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, t) for i, _, t in rows], "doc_id long, quality int, toxic int")
    tracemalloc.start()
    model = toxicity.train(docs, labels)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert b"horrid" in model.toxic and len(model.weights) == toxicity.FIGURES + 1
    assert peak < 2 << 20  # the texts alone are 1.4 MB, their words and runs many times that


def test_of_equal_ids_the_earlier_row_comes_first(spark):
    rows = made(60, 30)
    twice = [(i, t) for i, t, _ in rows] + [(i, t.upper() + " again") for i, t, _ in rows]
    docs = spark.createDataFrame(twice, "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, 1, t) for i, _, t in rows], "doc_id long, quality int, toxic int").repartition(3)
    assert toxicity.train(docs, labels) == toxicity.train(docs, labels)


def test_without_rows_of_a_class_there_is_no_model(spark):
    docs = spark.createDataFrame([(i, t) for i, t, _ in made(60, 30)], "doc_id long, text string")
    for toxic in (0, 1, None):
        labels = spark.createDataFrame([(i, 1, toxic) for i in range(60)], "doc_id long, quality int, toxic int")
        assert toxicity.train(docs, labels) is None
    labels = spark.createDataFrame([(i + 1000, 1, i % 2) for i in range(60)], "doc_id long, quality int, toxic int")
    assert toxicity.train(docs, labels) is None


def test_marks_by_plain_counting():
    rng = random.Random(3)
    n = 2 * toxicity.TOGETHER + 5
    bad = toxicity._joined(pa.array([prose(rng, 12, 300) + (" Horrid" if k % 9 == 0 else "") for k in range(n)] + ["", " \n "], pa.large_string()))
    good = toxicity._joined(pa.array([prose(rng, 12, 300) for _ in range(n)] + [""], pa.large_string()))
    for size in toxicity.GRAMS:

        def shares(texts):
            runs = [b" " + t + b" " for t in texts]
            found = Counter(r for t in runs for r in {t[i : i + size] for i in range(len(t) - size + 1)})
            return {int.from_bytes(r, "big"): c / len(texts) for r, c in found.items()}

        own, other = shares(bad), shares(good)
        grams, share = toxicity._shares(bad, size)
        assert dict(zip(grams.tolist(), share.tolist())) == own and (grams[1:] > grams[:-1]).all()
        plain = {g for g, s in own.items() if s >= toxicity.LEAST_SHARE and s * len(bad) >= toxicity.LEAST_TEXTS and s >= toxicity.TIMES * (other.get(g, 0.0) + 0.5 / len(good))}
        assert set(toxicity._marks(bad, good, size).tolist()) == plain and plain
