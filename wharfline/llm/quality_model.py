"""Quality scores from a sparse ensemble of rules.

Statistics of a text (all native expressions) are split by a forest of shallow trees; every path from a root to a node is a
rule, a conjunction of comparisons. A logistic regression with a lasso penalty weighs the rules; most get no weight. The rest
are compiled into one Spark expression, so scoring whole tables runs no Python at all.

Forest and regression are fitted on a bounded sample of labelled rows that aren't held out (``SAMPLE`` of each class).
Language, source, id and labels are never inputs.

Defined results: a null or empty text has all statistics at 0 and gets the score its rules give it; without labels of both
classes every score is the share of good labels (0.5 without labels); null ids aren't held out; repeated rows score alike.
Extra columns don't matter.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.once import once
from .labels import held_out
from .tables import BLANKS, column, has_word, word_list, written

#: Labelled rows of each class that are learnt from.
SAMPLE = {0: 5000, 1: 10_000}
TREES, DEPTH = 20, 3
LASSO = 0.001
THRESHOLD = 0.5

Rule = tuple[tuple[str, str, float], ...]


def _share(text: Column, chars: str, of: Column) -> Column:
    return (F.length(text) - F.length(F.translate(text, chars, ""))) / F.greatest(of, F.lit(1))


def statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """The statistics of every text, next to the named columns; arrays are built once per row."""
    rows = docs.select(*keep, F.coalesce(column(docs, "text", "string"), F.lit("")).alias("_text"))
    rows = once(rows, _words=word_list(F.col("_text")), _lines=F.filter(F.split("_text", "\n"), has_word))
    w, lines, text = F.col("_words"), F.col("_lines"), F.col("_text")
    rows = once(rows, n_words=F.size(w), n_chars=F.length(F.translate(text, BLANKS, "")), n_distinct=F.size(F.array_distinct(w)), n_lines=F.size(lines), n_new_lines=F.size(F.array_distinct(lines)))
    n, chars = F.col("n_words"), F.col("n_chars")
    one = F.lit(1)
    return rows.select(
        *keep,
        *[
            c.cast("double").alias(name)
            for name, c in {
                "log_words": F.log1p(n),
                "mean_word": chars / F.greatest(n, one),
                "distinct_share": F.col("n_distinct") / F.greatest(n, one),
                "symbol_share": _share(text, "#*$%&<>", chars),
                "bar_share": _share(text, "|", chars),
                "mark_share": _share(text, "!?", chars),
                "stop_share": _share(text, ".,;:", chars),
                "digit_share": _share(text, "0123456789", chars),
                "upper_share": _share(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", chars),
                "line_words": n / F.greatest(F.col("n_lines"), one),
                "dup_line_share": 1 - F.col("n_new_lines") / F.greatest(F.col("n_lines"), one),
                "bracket_share": _share(text, "{}[]()=_/\\@", chars),
            }.items()
        ],
    )


FEATURES = (
    "log_words mean_word distinct_share symbol_share bar_share mark_share stop_share digit_share upper_share line_words "
    "dup_line_share bracket_share"
).split()


def tree_rules(model) -> list[Rule]:
    """The paths of all trees, each once, without their order of comparisons."""
    rules: set[Rule] = set()

    def walk(node, path: tuple) -> None:
        if path:
            rules.add(tuple(sorted(path)))
        if node.numDescendants() == 0:
            return
        split = node.split()
        name, cut = FEATURES[split.featureIndex()], float(split.threshold())
        walk(node.leftChild(), (*path, (name, "<=", cut)))
        walk(node.rightChild(), (*path, (name, ">", cut)))

    for tree in model.trees:
        walk(tree._java_obj.rootNode(), ())
    return sorted(rules)


def compiled(rule: Rule) -> Column:
    """1 where all comparisons of a rule hold, else 0."""
    tests = [F.col(name) <= cut if sign == "<=" else F.col(name) > cut for name, sign, cut in rule]
    return reduce(lambda a, b: a & b, tests).cast("double")


def fit(measured: DataFrame, labels: DataFrame) -> tuple[float, list[tuple[Rule, float]]]:
    """Intercept and weighted rules. measured: doc_id and the statistics."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("label"))
    known = known.filter(F.col("doc_id").isNotNull() & F.col("label").isin(0.0, 1.0) & ~held_out(F.col("doc_id")))
    order = F.xxhash64("doc_id")
    sample = None
    for value, n in SAMPLE.items():
        part = known.filter(F.col("label") == value).orderBy(order, "doc_id").limit(n)
        sample = part if sample is None else sample.unionByName(part)
    counts = {int(r["label"]): r["count"] for r in known.groupBy("label").count().collect()}
    good, bad = counts.get(1, 0), counts.get(0, 0)
    rows = written(measured.join(F.broadcast(sample), "doc_id").select(*FEATURES, "label"), "quality-sample")
    taken = {int(r["label"]): r["count"] for r in rows.groupBy("label").count().collect()}
    if not taken.get(0) or not taken.get(1):
        from math import log

        share = (good + 1) / (good + bad + 2)
        return log(share / (1 - share)), []
    # the classes weigh as they occur among all labels
    weight = F.when(F.col("label") == 1, F.lit(good / taken[1])).otherwise(F.lit(bad / taken[0])) * F.lit((taken[0] + taken[1]) / (good + bad))
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows.coalesce(4).withColumn("weight", weight)).cache()
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, maxBins=64, seed=7, weightCol="weight", featureSubsetStrategy="onethird").fit(rows)
    rules = tree_rules(forest)
    names = [f"rule_{k}" for k in range(len(rules))]
    ruled = rows.select("label", "weight", *[compiled(r).alias(n) for r, n in zip(rules, names)])
    ruled = VectorAssembler(inputCols=names, outputCol="features").transform(ruled).select("label", "weight", "features").cache()
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=LASSO, maxIter=60, weightCol="weight", standardization=False).fit(ruled)
    rows.unpersist()
    ruled.unpersist()
    found = [(r, float(w)) for r, w in zip(rules, lasso.coefficients) if w != 0.0]
    return float(lasso.intercept), found


def quality_model(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    rows = docs.select(column(docs, "doc_id", "long").alias("doc_id"), column(docs, "text", "string").alias("text"))
    measured = written(statistics(rows, "doc_id"), "quality-statistics")
    intercept, rules = fit(measured, labels)
    total = reduce(lambda a, b: a + b, [F.lit(w) * compiled(r) for r, w in rules], F.lit(intercept))
    out = measured.withColumn("score", 1 / (1 + F.exp(-total)))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
