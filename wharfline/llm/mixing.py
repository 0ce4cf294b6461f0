"""Mixing sources to target weights.

Tokens are summed per source, a repetition rate follows from the source's target, and each document
is emitted ``floor(rate)`` times plus one more time with a probability equal to the fraction. The draw
is a hash of the document's id, so a rerun, or a task that runs twice, emits the same rows.

Defined results: a null text has size 0; a null source is a source of its own, ordered last; a null id
draws as the empty string; repeated rows are drawn alike; an empty table gives an empty mix. Extra
columns, whatever their names, pass through ``mix`` unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import column, word_count

#: A source is repeated at most so often.
MOST_REPEATS = 3
#: Weights of the sources in the order of their names, repeating.
WEIGHTS = (1, 2, 3)


def draw(doc_id: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of the id's MD5."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def source_rates(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """One row per source (columns ``source``, ``size``): its size, target and repetition rate.

    The caps are filled like water: a source at its cap keeps it, the others share the rest by weight.
    Sorted by cap for each unit of weight, the capped sources come first. Taking one more source as capped
    raises the level of the others as long as it really is above its cap, and lowers it afterwards, so the
    level is the highest of all. The windows run over one row per source.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    sources = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")))
    sources = sources.withColumn("cap", F.col("source_size") * most)
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    whole = by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0).cast("long")
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), zero)
    weight = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), zero)
    sources = sources.withColumn("level", left.cast("double") / weight.cast("double"))
    level = F.max("level").over(whole)
    target = F.least(F.col("cap").cast("double"), level * F.col("weight"))
    sources = sources.withColumn("target", target)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return sources.select("source", "source_size", "target", rate.alias("rate"))


def with_copies(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, size, source_size, target and how often each document is taken.

    The sources' table joins by its name made non-null; it holds one row per source and its side of the
    join is chosen by its size at run time.
    """
    sized = docs.select(
        column(docs, doc_id, docs.schema[doc_id].dataType).alias("doc_id"),
        F.col(f"`{source}`").alias("source"),
        word_count(F.col(f"`{text}`")).alias("size"),
    )
    return _joined(sized, source_rates(sized))


def _joined(sized: DataFrame, rates: DataFrame) -> DataFrame:
    key = F.concat(F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.lit("s")), F.coalesce("source", F.lit("")))
    rates = rates.select(key.alias("source_key"), "source_size", "target", "rate")
    taken = F.floor("rate") + (draw(F.col("doc_id")) < F.col("rate") - F.floor("rate")).cast("long")
    joined = sized.withColumn("source_key", key).join(rates, "source_key")
    return joined.withColumn("copies", taken).drop("source_key")


def mix(docs: DataFrame) -> DataFrame:
    """The documents, each as often as the mix takes it, with their own columns.

    A document without words can't move its source towards the target and is emitted by the same rule.
    """
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    sized = packed.select(
        "row",
        F.col("row.doc_id").alias("doc_id"),
        F.col("row.source").alias("source"),
        word_count(F.col("row.text")).alias("size"),
    )
    rates = source_rates(docs.select(F.col("source"), word_count(F.col("text")).alias("size")))
    copied = _joined(sized, rates).filter(F.col("copies") > 0)
    return copied.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")


def mixing_table(docs: DataFrame) -> DataFrame:
    out = with_copies(docs)
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


#: The same in DuckDB's SQL.
SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight, source_size * 3 AS cap
  FROM sources),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER w, 0))::DOUBLE
            / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0))::DOUBLE AS level
  FROM weighted
  WINDOW w AS (ORDER BY cap::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
filled AS (
  SELECT *, least(cap::DOUBLE, max(level) OVER () * weight) AS target
  FROM levels),
rates AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM filled)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate) + CASE WHEN ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT
                                        / 4503599627370496.0::DOUBLE < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM sized JOIN rates ON sized.source IS NOT DISTINCT FROM rates.source
"""
