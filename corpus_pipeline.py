"""A training corpus from the raw documents: each stage calls one operator and keeps whole rows.

The stages' results are written as Parquet and read again, so each one starts from a table and a lost
executor costs at most the stage it was busy with.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wharfline.llm import exact_dedup, mixing, ngram_join, packing, toxicity
from wharfline.llm.tables import table, written
from wharfline.session import prepare

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go.

    Null and empty texts score like others and stay unless rejected; repeated rows and null ids are judged row by row; an empty table stays empty.
    """
    return toxicity.without_toxic(docs, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one stays, the longest in the original, then the smallest id.

    Null counts as empty, so of all null, empty and blank texts one stays; null ids come last; of repeated rows one stays.
    """
    return exact_dedup.deduplicated(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar documents the one with the smallest id stays.

    Texts without words link with nothing and stay; unlinked rows with null or equal ids all stay; ties of id go by set, then the shorter text.
    """
    return ngram_join.deduplicated(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source is repeated towards its target.

    A null source is one of its own, after all others; texts without words have size 0; rows may come again, up to three times.
    """
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences.

    A null or empty text is its closing id alone; repeated rows are packed each; a null id keeps null; an empty table gives no pieces.
    """
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("ngram_join", without_near_copies),
    ("mixing", mixed),
    ("packing", packed),
]

#: A compression-trained model and a tokenizer are not SQL; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    for turn, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if turn < len(STAGES) - 1:
            docs = written(docs, f"corpus-{name}")
    return docs
