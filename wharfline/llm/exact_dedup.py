"""Exact deduplication against a minimal perfect hash over earlier digests.

Texts are equal when they are identical after all blanks are deleted. The distinct digests of the
history are cut into shards by their first bytes; each shard is one minimal perfect hash (hash and
displace: a seed for each bucket of keys, so that every key gets a slot of its own and no slot is free).
A slot holds the whole digest and where its winner is found: id, length and number of copies. A lookup
computes one slot and compares all 32 bytes, so a digest that was never seen is not taken for one that was.
New digests are grouped first, so a digest that a third of all rows share reaches its shard as a few rows.

Defined results: a null text counts as empty; of equal texts the longest original stays, then the
smallest id, a null id last; repeated rows of one id are one class whose first row in no given order
stays in ``deduplicated`` (they are equal in id and length). An empty history or an empty table is fine.
Extra columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import BLANKS, column, partitions, written

#: Digests a shard is meant to hold; shards grow in number, not in size.
SHARD_KEYS = 50_000
#: Keys for each bucket of the perfect hash.
BUCKET_KEYS = 4

INDEX_SCHEMA = "shard int, keys int, seeds binary, digests binary, ids binary, lengths binary, copies binary"
FOUND_SCHEMA = "digest binary, best_length long, best_id long, copies long"


def digest(text: Column) -> Column:
    return F.sha2(F.translate(F.coalesce(text, F.lit("")), BLANKS, "").cast("binary"), 256)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, the digest in hex and the length in code points of every row."""
    text = F.coalesce(column(docs, "text", "string"), F.lit(""))
    return docs.select(column(docs, "doc_id", "long").alias("doc_id"), digest(text).alias("text_sha256"), F.length(text).cast("long").alias("length"))


def grouped(rows: DataFrame, shards: int) -> DataFrame:
    """One row per distinct digest: the winner's length and id, the number of copies, the shard."""
    worst = F.lit(2**63 - 1).cast("long")
    order = F.struct((-F.col("length")).alias("l"), F.coalesce("doc_id", worst).alias("id"))
    out = rows.groupBy("text_sha256").agg(F.min(order).alias("best"), F.count(F.lit(1)).alias("copies"))
    shard = (F.conv(F.substring("text_sha256", 1, 8), 16, 10).cast("long") % shards).cast("int")
    return out.select(
        shard.alias("shard"),
        F.unhex("text_sha256").alias("digest"),
        (-F.col("best.l")).alias("best_length"),
        F.col("best.id").alias("best_id"),
        "copies",
    )


def slots(lanes: np.ndarray, seeds: np.ndarray, keys: int) -> np.ndarray:
    """The slot of each key under the seed of its bucket. lanes: 4 unsigned 64-bit numbers of each digest."""
    x = lanes[:, 2] ^ (seeds.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) + lanes[:, 3]
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return ((x ^ (x >> np.uint64(32))) % np.uint64(keys)).astype(np.int64)


def buckets(lanes: np.ndarray, n: int) -> np.ndarray:
    return (lanes[:, 1] % np.uint64(n)).astype(np.int64)


def perfect_hash(lanes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seeds of the buckets, and the slot of every key. Large buckets choose first."""
    keys = len(lanes)
    n = max(1, -(-keys // BUCKET_KEYS))
    bucket = buckets(lanes, n)
    order = np.argsort(bucket, kind="stable")
    size = np.bincount(bucket, minlength=n)
    begin = np.cumsum(size) - size
    seeds, slot, taken = np.zeros(n, np.uint32), np.zeros(keys, np.int64), np.zeros(keys, bool)
    for b in np.argsort(-size, kind="stable"):
        if not size[b]:
            break
        own = order[begin[b] : begin[b] + size[b]]
        if size[b] == 1:
            break
        base = 0
        while True:  # 64 seeds at a time
            tried = np.arange(base, base + 64, dtype=np.uint32)
            at = slots(np.tile(lanes[own], (64, 1)), np.repeat(tried, len(own)), keys).reshape(64, -1)
            free = ~taken[at].any(axis=1)
            for k in np.flatnonzero(free):
                if len(np.unique(at[k])) == len(own):
                    seeds[b], slot[own] = tried[k], at[k]
                    taken[at[k]] = True
                    break
            else:
                base += 64
                continue
            break
    # buckets of one key take the free slots directly: their seed names the slot
    single = np.flatnonzero(size == 1)
    free = np.flatnonzero(~taken)
    seeds[single] = free[: len(single)].astype(np.uint32)
    slot[order[begin[single]]] = free[: len(single)]
    return seeds, slot


def lookup(lanes: np.ndarray, seeds: np.ndarray, single: np.ndarray, keys: int) -> np.ndarray:
    bucket = buckets(lanes, len(seeds))
    at = slots(lanes, seeds[bucket], keys)
    return np.where(single[bucket], seeds[bucket].astype(np.int64), at)


def _lanes(digest_column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(map(bytes, digest_column)), dtype="<u8").reshape(-1, 4)


def _build(group: pd.DataFrame) -> pd.DataFrame:
    lanes = _lanes(group["digest"])
    seeds, slot = perfect_hash(lanes)
    single = np.bincount(buckets(lanes, len(seeds)), minlength=len(seeds)) == 1
    at = np.empty(len(slot), np.int64)
    at[slot] = np.arange(len(slot))
    held = np.concatenate([seeds.astype("<u4"), np.packbits(single).view(np.uint8).astype("<u4")]).tobytes()
    return pd.DataFrame(
        {
            "shard": [int(group["shard"].iloc[0])],
            "keys": [len(group)],
            "seeds": [held],
            "digests": [lanes[at].tobytes()],
            "ids": [group["best_id"].to_numpy("<i8")[at].tobytes()],
            "lengths": [group["best_length"].to_numpy("<i8")[at].tobytes()],
            "copies": [group["copies"].to_numpy("<i8")[at].tobytes()],
        }
    )


def build_index(history: DataFrame, shards: int) -> DataFrame:
    """The perfect hash of the distinct digests of a history, one row per shard, written to the shared folder."""
    rows = grouped(digests(history), shards)
    return written(rows.groupBy("shard").applyInPandas(_build, INDEX_SCHEMA), "digest-index")


def _probe(new: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    """Digests of one shard, old and new, each once, with the winner over both sides."""
    parts = []
    if len(index):
        row = index.iloc[0]
        keys = int(row["keys"])
        n = max(1, -(-keys // BUCKET_KEYS))
        held = np.frombuffer(row["seeds"], "<u4")
        seeds, single = held[:n], np.unpackbits(held[n:].astype(np.uint8))[:n].astype(bool)
        stored = np.frombuffer(row["digests"], "<u8").reshape(-1, 4)
        ids, lengths, copies = (np.frombuffer(row[c], "<i8").copy() for c in ("ids", "lengths", "copies"))
        if len(new):
            lanes = _lanes(new["digest"])
            at = lookup(lanes, seeds, single, keys)
            known = (stored[at] == lanes).all(axis=1)  # all 32 bytes
            slot, rows = at[known], new[known]
            length, best = rows["best_length"].to_numpy(), rows["best_id"].to_numpy()
            better = (length > lengths[slot]) | ((length == lengths[slot]) & (best < ids[slot]))
            lengths[slot[better]], ids[slot[better]] = length[better], best[better]
            copies[slot] += rows["copies"].to_numpy()
            new = new[~known]
        whole = stored.tobytes()
        texts = [whole[32 * k : 32 * k + 32] for k in range(keys)]
        parts.append(pd.DataFrame({"digest": texts, "best_length": lengths, "best_id": ids, "copies": copies}))
    if len(new):
        parts.append(new[["digest", "best_length", "best_id", "copies"]])
    return pd.concat(parts) if parts else pd.DataFrame(columns=["digest", "best_length", "best_id", "copies"])


def classes(history: DataFrame, arrivals: DataFrame) -> DataFrame:
    """Winner and size of every class of equal texts over a history and what came after it."""
    spark = history.sparkSession
    n = history.count() if history.columns else 0
    shards = max(partitions(spark), -(-n // SHARD_KEYS))
    index = build_index(history, shards)
    new = grouped(digests(arrivals), shards)
    found = new.groupBy("shard").cogroup(index.groupBy("shard")).applyInPandas(_probe, FOUND_SCHEMA)
    best = F.when(F.col("best_id") != 2**63 - 1, F.col("best_id"))
    return found.select(F.lower(F.hex("digest")).alias("text_sha256"), best.alias("keep_id"), "best_length", F.col("copies").alias("group_size"))


def split_history(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ids ascend as documents arrive: the older half of the id range is the history, the rest the arrivals."""
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    middle = ((low or 0) + (high or 0)) // 2
    old = F.coalesce(F.col("doc_id") <= middle, F.lit(False))
    return docs.filter(old), docs.filter(~old)


def exact_dedup(docs: DataFrame) -> DataFrame:
    """One row per document: the id that stays, the size of its class and whether it stays itself.

    Rows of one digest meet their class in a plain equality join; a hot digest's side is split at run time.
    """
    old, new = split_history(docs.select(column(docs, "doc_id", "long").alias("doc_id"), column(docs, "text", "string").alias("text")))
    found = classes(old, new)
    rows = digests(docs)
    out = rows.join(found, "text_sha256")
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("length") == F.col("best_length"))
    return out.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def deduplicated(docs: DataFrame) -> DataFrame:
    """The documents that stay, with their own columns; of repeated rows of the winner, one."""
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    keyed = own.select(
        "row",
        digest(F.col("row.text")).alias("text_sha256"),
        F.length(F.coalesce(F.col("row.text"), F.lit(""))).cast("long").alias("length"),
    )
    old, new = split_history(docs.select("doc_id", "text"))
    found = classes(old, new)
    winners = keyed.join(found, "text_sha256").filter(
        F.col("row.doc_id").eqNullSafe(F.col("keep_id")) & (F.col("length") == F.col("best_length"))
    )
    # only repeated rows of one id are left to tell apart
    again = Window.partitionBy("text_sha256").orderBy("length")
    return winners.withColumn("turn", F.row_number().over(again)).filter("turn = 1").select("row.*")


#: The same in DuckDB's SQL.
SQL = r"""
WITH rows AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents),
ranked AS (
  SELECT *, first_value(doc_id) OVER w AS keep_id, first_value(n) OVER w AS best,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM rows WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, group_size, (doc_id IS NOT DISTINCT FROM keep_id AND n = best) AS kept, text_sha256 FROM ranked
"""
