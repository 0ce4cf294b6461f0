"""Ordered per-key operators that survive keys of any size.

A window over one key sorts all rows of that key in one task. Here the key's
history is cut into chunks of its order column (a span of offsets or of time).
Each chunk is one window group, so a hot key is spread over many tasks. One row
per chunk, pre-aggregated before its shuffle, then carries the value from chunk
to chunk. The result is the same as that of the plain window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_CHUNK = "__chunk"
_GROUP = "__group"
_VALUE = "__value"
_INSIDE = "__inside"
_EDGE = "__edge"
_CARRY = "__carry"


def chunk_by_offset(offset: Column | str, size: int = 1_000_000) -> Column:
    """Chunk number of an offset; a chunk holds at most ``size`` rows of a partition."""
    c = F.col(offset) if isinstance(offset, str) else offset
    return F.floor(c / size).cast("bigint")


def chunk_by_time(ts: Column | str, seconds: int = 3600) -> Column:
    """Chunk number of a timestamp."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.floor(F.unix_micros(c) / (seconds * 1_000_000)).cast("bigint")


def row_chunks(
    df: DataFrame, keys: Sequence[str], ts: str, size: int = 1_000_000, bucket_secs: float = 1, name: str = "chunk"
) -> DataFrame:
    """Add a chunk number that follows the rows instead of the time, for keys whose rows come in bursts.

    Rows are counted per key and bucket of time first. A chunk ends with the bucket that fills it, so it holds fewer than
    ``size`` rows more than its largest bucket. The counts, one row per bucket, are all that one key's window sees. Give
    the column as ``chunk`` to the operators here. Null times make a bucket before all others; null keys are a key.
    """
    bucket = F.floor(F.unix_micros(ts) / int(bucket_secs * 1_000_000))
    rows = df.withColumn("__bucket", bucket)
    counts = rows.groupBy(*keys, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy(*keys).orderBy(F.col("__bucket").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    cuts = counts.select(
        *[F.col(k).alias(f"__key{i}") for i, k in enumerate(keys)],
        F.col("__bucket").alias("__at"),
        F.floor(F.coalesce(F.sum("__n").over(earlier), F.lit(0)) / size).cast("bigint").alias(name),
    )
    same = F.col("__bucket").eqNullSafe(F.col("__at"))
    for i, k in enumerate(keys):
        same &= F.col(k).eqNullSafe(F.col(f"__key{i}"))
    return rows.join(cuts, same).select(*df.columns, name)


def _grouped(df: DataFrame, keys: Sequence[str], value: Column, chunk: Column) -> DataFrame:
    """Rows with their value, their chunk and the name of their window group.

    The name is a struct of keys and chunk. Structs are never null and equal each other where null keys do,
    so the window and the join that follows are dealt alike and the full rows are shuffled once.
    """
    rows = df.withColumn(_CHUNK, chunk).withColumn(_VALUE, value)
    return rows.withColumn(_GROUP, F.struct(*keys, _CHUNK))


def _parts(keys: Sequence[str]) -> list[Column]:
    return [F.col(f"{_GROUP}.{k}").alias(k) for k in (*keys, _CHUNK)]


def _attach(rows: DataFrame, carry: DataFrame) -> DataFrame:
    """Left join of the carried value on the window group."""
    return rows.join(carry.select(_GROUP, _CARRY), _GROUP, "left")


def _neighbour(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    name: str,
    chunk: Column,
    *,
    backwards: bool,
) -> DataFrame:
    rows = _grouped(df, keys, value, chunk)
    by = [F.col(c).desc() if backwards else F.col(c).asc() for c in order]
    inner = (
        Window.partitionBy(_GROUP).orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    )
    seen = rows.withColumn(_INSIDE, F.last(_VALUE, ignorenulls=True).over(inner))

    position = F.when(F.col(_VALUE).isNotNull(), F.struct(*order))
    pick = F.min_by if backwards else F.max_by
    edges = rows.groupBy(_GROUP).agg(pick(F.col(_VALUE), position).alias(_EDGE)).select(_GROUP, _EDGE, *_parts(keys))
    step = F.col(_CHUNK).desc() if backwards else F.col(_CHUNK).asc()
    outer = Window.partitionBy(*keys).orderBy(step).rowsBetween(Window.unboundedPreceding, -1)
    carry = edges.withColumn(_CARRY, F.last(_EDGE, ignorenulls=True).over(outer)).where(
        F.col(_CARRY).isNotNull()
    )
    return (
        _attach(seen, carry)
        .withColumn(name, F.coalesce(_INSIDE, _CARRY))
        .drop(_GROUP, _CHUNK, _VALUE, _INSIDE, _CARRY)
    )


def previous_value(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, name: str, chunk: Column
) -> DataFrame:
    """Add the latest non-null ``value`` among the rows before this one."""
    return _neighbour(df, keys, order, value, name, chunk, backwards=False)


def following_value(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, name: str, chunk: Column
) -> DataFrame:
    """Add the first non-null ``value`` among the rows after this one."""
    return _neighbour(df, keys, order, value, name, chunk, backwards=True)


def running_sum(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, name: str, chunk: Column
) -> DataFrame:
    """Add the sum of ``value`` up to and including this row. ``order`` must be unique per key."""
    rows = _grouped(df, keys, value, chunk)
    inner = (
        Window.partitionBy(_GROUP).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    )
    seen = rows.withColumn(_INSIDE, F.sum(_VALUE).over(inner))
    edges = rows.groupBy(_GROUP).agg(F.sum(_VALUE).alias(_EDGE)).select(_GROUP, _EDGE, *_parts(keys))
    outer = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carry = edges.withColumn(_CARRY, F.sum(_EDGE).over(outer)).where(F.col(_CARRY) != 0)
    return (
        _attach(seen, carry)
        .withColumn(name, F.col(_INSIDE) + F.coalesce(F.col(_CARRY), F.lit(0)))
        .drop(_GROUP, _CHUNK, _VALUE, _INSIDE, _CARRY)
    )


def in_order(df: DataFrame, partition: str = "partition", offset: str = "offset") -> DataFrame:
    """Rows of each task in processing order."""
    return df.sortWithinPartitions(partition, offset)
