"""Quality rules whose cutoffs carry a guarantee against false rejection.

Each rule rejects a document whose measure lies above a cutoff. A stratum (language) has one tightness: its rules'
cutoffs lie that many spreads above the middle of its good labelled documents, so the rules are tightened together and what
is tested is the joint rule, "any of them rejects". A tightness is allowed if, by the exact binomial tail, the share of good
documents it rejects is proved to lie below ``limit``. Middles and spreads come from a quarter of the good documents (by a
hash of the id), the test from the others. Tightnesses are tested from the loosest on and the tests end at the
first one that fails, so within a stratum no correction is due; over strata the level is divided by their number (Bonferroni).

A stratum with too few good documents to prove the limit by itself, even if none is rejected, is tested together with all
others of that kind: each keeps its own middles and spreads, they share the tightness, and the promise holds for them taken
together. With probability 1 - ``level`` in no tested group more than ``limit`` of the good documents are rejected. If not even
the group can prove it (at 1% and 5%: below 299 good documents for the test, about 400 labelled), its rules reject nothing.

All of it is DataFrame expressions. The costly arrays of a document are built once, in a generator row.

Defined results: a null or empty text has no words and fails the base rule; a null language is a stratum of
its own; documents and labels with null ids don't meet; a document labelled twice counts for each label; an
empty labels table leaves the base rule alone. Extra columns don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.once import once
from .tables import BLANKS, column, has_word, word_list, written

#: Characters counted as symbols.
SYMBOLS = "#*$%&|<>"
LIMIT = 0.01
LEVEL = 0.05
#: Measures, each "the higher, the worse", as expressions over the base columns.
MEASURES = {
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "same_word_share": "1 - n_distinct / greatest(n_words, 1)",
    "mark_share": "n_marks / greatest(word_chars, 1)",
    "mean_word": "word_chars / greatest(n_words, 1)",
    "short_word": "- word_chars / greatest(n_words, 1)",
}
#: Least spreads: 0.01 for shares, a quarter of a character for word lengths. A measure may be 0 in all good documents.
SPREADS = {name: 0.25 if name.endswith("_word") else 0.01 for name in MEASURES}
#: Tightnesses tried, in spreads (the 99% quantile above the median), loosest first.
TRIED = (8.0, 7.0, 6.0, 5.0, 4.5, 4.0, 3.5, 3.0, 2.75, 2.5, 2.25, 2.0, 1.75, 1.5, 1.25, 1.0)


def _lost(text: Column, chars: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def base_columns(docs: DataFrame, *keep: str) -> DataFrame:
    """The base counts of every document, next to the named columns."""
    text = F.coalesce(column(docs, "text", "string"), F.lit(""))
    rows = docs.select(*keep, text.alias("_text"))
    rows = once(rows, _words=word_list(F.col("_text")))
    lines = F.filter(F.split("_text", "\n"), has_word)
    w = F.col("_words")
    rows = once(
        rows.withColumn("n_words", F.size(w).cast("long")),
        _lines=lines,
        _hashes=F.when(
            F.size(w) >= 5,
            F.transform(F.sequence(F.lit(0), F.size(w) - 5), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(5)])),
        ),
        n_distinct=F.size(F.array_distinct(w)).cast("long"),
    )
    text = F.col("_text")
    rows = once(
        rows.drop("_words"),
        word_chars=F.length(F.translate(text, BLANKS, "")).cast("long"),
        n_symbols=_lost(text, SYMBOLS),
        n_upper=_lost(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        n_marks=_lost(text, "!?"),
        n_lines=F.size("_lines").cast("long"),
        n_dup_lines=(F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        # most texts repeat no window: only the others are sorted
        _pairs=F.when(
            F.size(F.array_distinct("_hashes")) < F.size("_hashes"),
            F.array_sort(F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    ).drop("_text", "_lines", "_hashes")
    pairs = F.col("_pairs")
    same = lambda a, b: a["h"].eqNullSafe(b["h"])
    found = F.filter(pairs, lambda p, k: same(p, F.get(pairs, k - 1)) | same(p, F.get(pairs, k + 1)))
    rows = once(rows, _places=F.array_sort(F.transform(found, lambda p: p["i"]))).drop("_pairs")
    places = F.col("_places")
    covered = F.aggregate(
        places,
        F.struct(F.lit(0).cast("long").alias("sum"), F.lit(0).cast("long").alias("end")),
        lambda a, i: F.struct(
            (a["sum"] + (i + 5) - F.greatest(a["end"], i.cast("long"))).alias("sum"), (i + 5).cast("long").alias("end")
        ),
        lambda a: a["sum"],
    )
    return rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("_places")


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def log_tail(k: Column, n: Column, p: float) -> Column:
    """log P(X <= k) for X binomial(n, p), added up term by term from its exact ratios, in logs."""
    from math import log

    first = n.cast("double") * F.lit(log(1 - p))
    step = F.lit(log(p) - log(1 - p))
    return F.aggregate(
        F.sequence(F.lit(1).cast("long"), F.greatest(k, F.lit(1).cast("long"))),
        F.struct(first.alias("term"), first.alias("sum")),
        lambda a, i: _grown(a, i, k, n, step),
        lambda a: a["sum"],
    )


def _grown(a: Column, i: Column, k: Column, n: Column, step: Column) -> Column:
    term = a["term"] + F.log((n - i + 1).cast("double") / i.cast("double")) + step
    high, low = F.greatest(a["sum"], term), F.least(a["sum"], term)
    total = F.when(i <= k, high + F.log1p(F.exp(low - high))).otherwise(a["sum"])
    return F.struct(term.alias("term"), total.alias("sum"))


def _above(name: str) -> Column:
    """A measure's distance above its stratum's middle, in spreads."""
    return (F.col(name).cast("double") - F.col(f"_middle_{name}")) / F.col(f"_spread_{name}")


def cutoffs(labelled: DataFrame, limit: float = LIMIT, level: float = LEVEL) -> DataFrame:
    """The tightest allowed joint rule of each stratum: its tightness, and the middle and spread of each measure.

    labelled: doc_id, stratum, good, and the measures. Middles and spreads come from other documents than those that test.
    """
    from math import log

    tests = F.xxhash64("doc_id") % 4 != 0
    good = labelled.filter("good").select("stratum", tests.alias("_tests"), *MEASURES)
    seen = [F.percentile_approx(F.col(name).cast("double"), [0.5, 0.99], 10_000).alias(f"_{name}") for name in MEASURES]
    scale = good.filter(~F.col("_tests")).groupBy("stratum").agg(*seen)
    scale = scale.select(
        "stratum",
        *[F.col(f"_{name}")[0].alias(f"_middle_{name}") for name in MEASURES],
        *[F.greatest(F.col(f"_{name}")[1] - F.col(f"_{name}")[0], F.lit(SPREADS[name])).alias(f"_spread_{name}") for name in MEASURES],
    )
    worst = F.greatest(*[_above(name) for name in MEASURES])
    counted = (
        good.filter("_tests")
        .join(scale, "stratum")
        .groupBy("stratum")
        .agg(F.count(F.lit(1)).alias("n"), *[F.count_if(worst > t).alias(f"_k{i}") for i, t in enumerate(TRIED)])
    )
    # so many, none rejected, prove the limit at the level divided by the strata
    strata = counted.agg(F.count(F.lit(1)).alias("_strata"))
    alone = F.col("n") >= F.ceil((F.log(F.col("_strata").cast("double")) - F.lit(log(level))) / F.lit(-log(1 - limit)))
    # a stratum by itself, or one of the small ones
    counted = counted.join(strata, F.lit(True)).withColumn("_group", F.when(alone, F.concat(F.lit("="), "stratum")).otherwise(""))
    turns = F.array(*[F.struct(F.lit(i).alias("turn"), F.lit(t).alias("tightness"), F.col(f"_k{i}").alias("k")) for i, t in enumerate(TRIED)])
    summed = counted.select("_group", "n", F.explode(turns).alias("_t")).groupBy("_group", "_t.turn", "_t.tightness")
    summed = summed.agg(F.sum("n").alias("n"), F.sum("_t.k").alias("k"))
    groups = counted.agg(F.count_distinct("_group").alias("_groups"))
    allowed = log_tail(F.col("k"), F.col("n"), limit) <= F.log(F.lit(level) / F.col("_groups"))
    tested = summed.join(groups, F.lit(True)).withColumn("_allowed", allowed)
    # tests run from the loosest on; everything from the first failure on is out
    failed = F.coalesce(F.min(F.when(~F.col("_allowed"), F.col("turn"))), F.lit(len(TRIED)))
    best = tested.groupBy("_group").agg(F.get(F.array(*map(F.lit, TRIED)), failed - 1).alias("tightness")).filter("tightness IS NOT NULL")
    return scale.join(counted.select("stratum", "_group").join(best, "_group").drop("_group"), "stratum")


def quality_rules(docs: DataFrame, labels: DataFrame, limit: float = LIMIT, level: float = LEVEL) -> DataFrame:
    """One row per document: the base counts, ``base_failed``, ``kept`` and the names of the rules that reject it."""
    stratum = F.coalesce(column(docs, "lang", "string"), F.lit(""))
    rows = docs.select(column(docs, "doc_id", "long").alias("doc_id"), stratum.alias("stratum"), column(docs, "text", "string").alias("text"))
    counts = written(base_columns(rows, "doc_id", "stratum"), "quality-counts")
    measured = counts.withColumns({name: F.expr(rule) for name, rule in MEASURES.items()})
    good = labels.select(F.col("doc_id"), (F.col("quality") == 1).alias("good"))
    chosen = cutoffs(measured.filter(~base_failed()).join(good, "doc_id"), limit, level)
    judged = measured.join(chosen, "stratum", "left")
    broken = F.array_compact(F.array(*[F.when(_above(name) > F.col("tightness"), F.lit(name)) for name in MEASURES]))
    judged = judged.withColumn("base_failed", base_failed()).withColumn("broken", broken)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.size("broken") == 0)).alias("kept"),
        F.array_join("broken", ",").alias("broken_rules"),
    )
