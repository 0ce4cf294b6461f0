"""Reading tables, cutting lineage and small column helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import run_folder

#: The characters that part words, as text for translate().
BLANKS = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the folder all executors share and read it back.

    This cuts the lineage: what follows survives a lost executor without running what came before.
    """
    spark = df.sparkSession
    path = run_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def column(df: DataFrame, name: str, kind: T.DataType) -> Column:
    """A column by its name, or a typed null where the table has none."""
    return F.col(f"`{name}`").cast(kind) if name in df.columns else F.lit(None).cast(kind)


def has_word(text: Column) -> Column:
    return F.translate(text, BLANKS, "") != ""


def word_list(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text; none for null."""
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), BLANKS, " " * len(BLANKS)), " ")
    return F.array_remove(parts, "")


def word_count(text: Column) -> Column:
    return F.size(word_list(text)).cast("long")
