"""The registered queries of the operators, over whole tables, with their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from ..session import prepare
from . import collocations, exact_dedup, html_text, license_scan, lm_score, mixing, ngram_join, packing, periodic_runs, quality_model, quality_rules, substring_dedup, toxicity
from .tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir.rstrip("/"))

        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return run

    return register


@query()
def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(table(spark, sf_dir, "documents"))


@query(exact_dedup.SQL)
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


@query(mixing.SQL)
def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing_table(table(spark, sf_dir, "documents"))


@query()
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(table(spark, sf_dir, "documents"))


@query()
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


@query()
def op6_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.quality_model(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), with_ids=False)


@query()
def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.html_text(table(spark, sf_dir, "pages"))


@query(periodic_runs.SQL)
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.with_planted_runs(table(spark, sf_dir, "documents"))
    return periodic_runs.run_digests(periodic_runs.periodic_runs(docs))


@query(collocations.SQL)
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query()
def op13_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.lm_score(table(spark, sf_dir, "documents"))
