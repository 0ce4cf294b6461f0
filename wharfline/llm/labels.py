"""Labelled rows to learn from: never those held out, and never more than a stated number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import column


def held_out(doc_id: Column) -> Column:
    """Rows whose crc32(doc_id as text) mod 3 is 1; a null id is the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, most: dict[int, int], most_chars: int) -> DataFrame:
    """doc_id, text, label and the rank by a hash of the id, of a bounded number of rows of each class.

    The ids are chosen first (the smallest hashes), so what is broadcast has at most ``sum(most.values())``
    rows; texts above ``most_chars`` code points don't teach. Labels with null ids meet no document.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(target).cast("int").alias("label"))
    known = known.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).withColumn("order", F.xxhash64("doc_id"))
    chosen = None
    for value, n in most.items():
        part = known.filter(F.col("label") == value).orderBy("order", "doc_id").limit(n)
        chosen = part if chosen is None else chosen.unionByName(part)
    chosen = chosen.groupBy("doc_id").agg(F.max("label").alias("label"), F.min("order").alias("order"))
    texts = docs.select(column(docs, "doc_id", "long").alias("doc_id"), column(docs, "text", "string").alias("text"))
    texts = texts.filter(F.length("text") <= most_chars)
    return texts.join(F.broadcast(chosen), "doc_id")
