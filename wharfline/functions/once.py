"""Expressions that are evaluated once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add or replace columns whose costly expressions must not be repeated.

    The optimiser copies a projected expression into every later filter that
    uses it. It does not do so across a generator, so the columns come out of
    one that yields exactly one row.
    """
    kept = [c for c in df.columns if c not in columns]
    row = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select(*kept, F.inline(F.array(row)))
