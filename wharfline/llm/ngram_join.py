"""N-gram Jaccard join by vertical partitioning.

Every document's set of word shingles is cut along a global order of shingles into fragments; overlaps are
counted fragment by fragment and added up per pair. The steps:

1.  Texts with equal sets are one set from here on (a 96-bit signature names it).
2.  The shingles of all sets go to fragments of the hash space. A fragment counts in how many sets each of
    its shingles is found and sends back only the shared ones. A set with fewer than 75% shared shingles can't
    link with anything and is out; this leaves a few per cent of a natural corpus.
3.  The global order is (number of sets, hash): rare shingles first. Each remaining set is cut at fixed
    pivots of this order into segments.
4.  Links to a centre: sets with the same minimum under a few random orders are compared with the most
    central of them. Large groups of near copies become one component here, with one comparison per set and order.
5.  The rest, without loss: two sets that link share a shingle of both their prefixes in the global order
    (the first n - ceil(0.75 n) + 1). All pairs that do, that are of fitting length, have enough shingles left
    from there on and aren't yet in one component are compared. A shingle whose sets are all in one component yields no pair at all.
6.  Comparing a pair is: join the segments of both sides by fragment, count the partial overlaps, add them up.
7.  Every link lies inside a component. To count them all, a component's sets are dealt into blocks of bounded weight by size
    class and a hash of the set; each two blocks of the same or neighbouring size classes are one small task that adds up
    the overlaps by ranges of shingles. A set is sent, and answered with one number, once for each partner block, not once for each pair.

Defined results: null, empty and blank texts have an empty set and link with nothing; a text of fewer than
``width`` words is one shingle that equals only the same short text; repeated rows are equal sets and link;
null ids take part but never name a component unless all its ids are null. Extra columns don't matter.
Shingles are compared by 64-bit hashes, sets by 96-bit signatures.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import components
from .sharing import KEY, answered, answers, edges_of, shared
from .tables import column, has_word, written
from .words import factors, mix, slices, windows, words_of

WIDTH = 5
#: Least similarity in per cent.
LEAST = 75
#: Pivots of the global order: segment k holds shingles of fewer than 2 ** (k + 2) sets.
SEGMENTS = 8
#: Random orders for the links to a centre.
CENTRES = 4
#: Shingles of a block of sets; a set weighs at least LIGHT, so a block is two thousand sets at most.
BLOCK = 1 << 19
LIGHT = 256
#: Columns of the overlap matrices that are held at a time.
WIDE = 1024

SETS_SCHEMA = "doc_id long, n_shingles long, key binary"
CANDIDATE_SCHEMA = "key binary, n long, alone long, off_centre double, centres array<long>, prefix array<long>, segments array<struct<part:int,hashes:array<long>>>"


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for begin, end in slices(texts):
        words = words_of(texts.slice(begin, end - begin), lower=True)
        hashes = words.hashes()
        grams = windows(hashes, width)
        for k in range(end - begin):
            first, last = int(words.first[k]), int(words.first[k + 1])
            if last - first >= width:
                own = np.sort(grams[first : last - width + 1])
                yield own[np.concatenate(([True], own[1:] != own[:-1]))]
            elif last > first:
                whole = hashes[first:last] * factors(last - first, seed=3)
                yield mix(np.array([whole.sum(dtype=np.uint64) + np.uint64(last - first)], dtype=np.uint64))
            else:
                yield np.zeros(0, np.uint64)


def signature(own: np.ndarray) -> tuple[int, int]:
    """96 bits that name a set: a sum over its members, and how many they are."""
    total = mix(own ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return int(total), len(own)


def _keyed(sets: list[np.ndarray]) -> np.ndarray:
    return np.array([signature(s) for s in sets], dtype=KEY)


def document_sets(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles and the name of each document's set (null for an empty set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(shingle_sets(batch.column("text"), width))
            keys = [k.tobytes() if len(s) else None for k, s in zip(_keyed(sets), sets)]
            sizes = pa.array([len(s) for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), sizes, pa.array(keys, pa.binary())], ["doc_id", "n_shingles", "key"])

    rows = docs.select(column(docs, "doc_id", "long").alias("doc_id"), column(docs, "text", "string").alias("text"))
    return rows.mapInArrow(run, SETS_SCHEMA)


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for batch in batches:
            for own in shingle_sets(batch.column("text"), width):
                yield np.array([signature(own)], dtype=KEY), own

    return run


def in_two_sets(flat: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Within a fragment: keep the shingles of two sets or more, with their number of sets."""
    edges = edges_of(flat)
    counts = np.repeat(np.diff(edges), np.diff(edges))
    return counts > 1, counts


def _candidates(least: int, segments: int, centres: int):
    """Sets with enough shared shingles, cut into segments of the global order."""
    masks = factors(centres, seed=4)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        for key, flat, counts in answers(batches):
            n, shared = int(key["b"]), len(flat)
            if 100 * shared < least * n:
                continue
            own = flat.view("<i8")
            cut = np.minimum(np.log2(counts).astype(int) - 1, segments - 1)
            at = edges_of(cut)
            prefix = n - -(-least * n // 100) + 1 - (n - shared)
            out.append(
                {
                    "key": key.tobytes(),
                    "n": n,
                    "alone": n - shared,
                    "off_centre": -float(np.log2(counts).sum()) / n,
                    "centres": [int(mix(flat ^ m).min().view("<i8")) for m in masks],
                    "prefix": own[: max(prefix, 0)].tolist(),
                    "segments": [{"part": int(cut[i]), "hashes": own[i:j].tolist()} for i, j in zip(at[:-1], at[1:])],
                }
            )
            if len(out) >= 500:
                yield pa.RecordBatch.from_pylist(out, schema=_CANDIDATES)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_CANDIDATES)

    return run


_CANDIDATES = pa.schema(
    [
        ("key", pa.binary()), ("n", pa.int64()), ("alone", pa.int64()), ("off_centre", pa.float64()), ("centres", pa.list_(pa.int64())), ("prefix", pa.list_(pa.int64())),
        ("segments", pa.list_(pa.struct([("part", pa.int32()), ("hashes", pa.list_(pa.int64()))]))),
    ]
)


def candidate_sets(docs: DataFrame, width: int = WIDTH, least: int = LEAST) -> DataFrame:
    """The sets that share enough shingles with others, each once, cut into segments."""
    rows = docs.select(column(docs, "text", "string").alias("text"))
    found = answered(shared(rows, _sets(width), in_two_sets, "text"), _candidates(least, SEGMENTS, CENTRES), CANDIDATE_SCHEMA, _CANDIDATES)
    return written(found, "ngram-sets")


def fits(a: Column, b: Column, least: int) -> Column:
    """Whether two sizes allow the similarity at all."""
    return 100 * F.least(a, b) >= least * F.greatest(a, b)


def links(pairs: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """The pairs (a, b, n_a, n_b) that are similar enough: overlaps counted by fragment and added up."""
    segments = sets.select("key", F.explode("segments").alias("s")).select("key", "s.part", "s.hashes")
    left = segments.select(F.col("key").alias("a"), "part", F.col("hashes").alias("in_a"))
    right = segments.select(F.col("key").alias("b"), "part", F.col("hashes").alias("in_b"))
    partial = pairs.join(left, "a").join(right, ["b", "part"])
    partial = partial.withColumn("overlap", F.size(F.array_intersect("in_a", "in_b")).cast("long"))
    summed = partial.groupBy("a", "b", "n_a", "n_b").agg(F.sum("overlap").alias("overlap"))
    union = F.col("n_a") + F.col("n_b") - F.col("overlap")
    return summed.filter(100 * F.col("overlap") >= least * union).select("a", "b")


def centre_pairs(sets: DataFrame, least: int) -> DataFrame:
    """Each set with the most central one of those with the same minimum under one of the random orders.

    Of near copies the text they all derive from is the most central: its shingles are found in most sets.
    """
    keyed = sets.select("key", "n", "off_centre", F.posexplode("centres").alias("turn", "least_hash"))
    centre = keyed.groupBy("turn", "least_hash").agg(F.min(F.struct("off_centre", "key", "n")).alias("c"), F.count(F.lit(1)).alias("m"))
    centre = centre.filter("m > 1").select("turn", "least_hash", F.col("c.key").alias("b"), F.col("c.n").alias("n_b"))
    pairs = keyed.join(centre, ["turn", "least_hash"]).filter("key <> b")
    pairs = pairs.filter(fits(F.col("n"), F.col("n_b"), least))
    return pairs.select(F.col("key").alias("a"), "b", F.col("n").alias("n_a"), "n_b").distinct()


def prefix_pairs(sets: DataFrame, labels: DataFrame, least: int) -> DataFrame:
    """Pairs of different components that share a shingle of both prefixes, fit in length and have enough shingles left."""
    posted = sets.select("key", "n", "alone", "prefix").join(labels.withColumnRenamed("node", "key"), "key")
    posted = posted.select("key", "n", "label", "alone", F.posexplode("prefix").alias("turn", "gram"))
    # shingles of the set from this one on, in the global order; those found in it alone come first
    posted = posted.select("key", "n", "label", "gram", (F.col("n") - F.col("alone") - F.col("turn")).alias("left"))
    posted = written(posted, "ngram-prefixes")
    mixed = posted.groupBy("gram").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    posted = posted.join(mixed.filter("low <> high").select("gram"), "gram", "left_semi")
    a = posted.select("gram", *[F.col(c).alias(f"{c}_a") for c in ("key", "n", "label", "left")])
    b = posted.select("gram", *[F.col(c).alias(f"{c}_b") for c in ("key", "n", "label", "left")])
    apart = (F.col("key_a") < F.col("key_b")) & (F.col("label_a") != F.col("label_b")) & fits(F.col("n_a"), F.col("n_b"), least)
    # if this is the first shingle both have, the overlap is at most what is left of either
    enough = (100 + least) * F.least("left_a", "left_b") >= least * (F.col("n_a") + F.col("n_b"))
    pairs = a.join(b, "gram").filter(apart & enough)
    return pairs.select(F.col("key_a").alias("a"), F.col("key_b").alias("b"), "n_a", "n_b").distinct()


def similar_sets(sets: DataFrame, least: int = LEAST) -> DataFrame:
    """node, label: components of the candidate sets under links of enough similarity."""
    nodes = sets.select(F.col("key").alias("node"))
    near = links(centre_pairs(sets, least), sets, least)
    labels = written(components(nodes, near), "ngram-labels")
    rest = links(prefix_pairs(sets, labels, least), sets, least)
    # links between components join their labels
    named = labels.select(F.col("node").alias("a"), F.col("label").alias("label_a"))
    rest = rest.join(named, "a").join(named.toDF("b", "label_b"), "b")
    over = components(labels.select(F.col("label").alias("node")).distinct(), rest.select(F.col("label_a").alias("a"), F.col("label_b").alias("b")))
    over = over.select(F.col("node").alias("label"), F.col("label").alias("top"))
    return labels.join(over, "label").select("node", F.col("top").alias("label"))


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """The number of common shingles of every two sets, added up over ranges of shingles."""
    place = np.unique(np.concatenate([*left, *right]), return_inverse=True)[1]
    owner = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in (*left, *right)])
    order = np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    total = np.zeros((len(left), len(right)))
    for begin in range(0, int(place[-1]) + 1 if len(place) else 0, WIDE):
        i, j = np.searchsorted(place, (begin, begin + WIDE))
        found = np.zeros((len(left) + len(right), WIDE), np.float32)
        found[owner[i:j], place[i:j] - begin] = 1
        total += found[: len(left)] @ found[len(left) :].T
    return total.astype(np.int64)


def _link_sums(least: int):
    """For each set of two blocks, or of one within itself: the copies of the sets of the other side it links with."""

    def run(block: pa.Table) -> pa.Table:
        side = block.column("side").to_numpy()
        n, copies = block.column("n").to_numpy(), block.column("copies").to_numpy()
        flat = [np.asarray(x, np.int64) for x in block.column("hashes").to_pylist()]
        within = bool(block.column("within")[0].as_py())
        a = np.flatnonzero(side == 0)
        b = a if within else np.flatnonzero(side == 1)
        sums = np.zeros(len(side), np.int64)
        if len(a) and len(b):
            both = _overlaps([flat[k] for k in a], [flat[k] for k in b])
            hit = 100 * both >= least * (n[a][:, None] + n[b][None, :] - both)
            if within:
                np.fill_diagonal(hit, False)
            sums[a] = hit @ copies[b]
            if not within:
                sums[b] = hit.T @ copies[a]
        some = sums > 0
        return pa.table([block.column("key").filter(pa.array(some)), pa.array(sums[some])], ["key", "n_links"])

    return run


def link_counts(sets: DataFrame, named: DataFrame, least: int = LEAST) -> DataFrame:
    """key, n_links: for every set the documents of other sets that are similar enough. named: key, label, copies.

    Pairs are never written: two blocks give a row for each set that links with any of the other side.
    """
    from math import log

    own = sets.select("key", "n", F.flatten("segments.hashes").alias("hashes")).join(named.select("key", "label", "copies"), "key")
    # classes are a little wider than the similarity allows, so sets that can link lie in the same or in neighbouring ones
    own = own.withColumn("class", F.floor(F.log(F.col("n").cast("double")) / F.lit(log(100 / least * 1.05))))
    sized = own.groupBy("label", "class").agg(F.count(F.lit(1)).alias("members"), F.sum(F.greatest(F.col("n"), F.lit(LIGHT))).alias("weight"))
    sized = sized.select("label", "class", "members", F.ceil(F.col("weight") / BLOCK).alias("blocks"))
    sized = written(sized, "ngram-blocks")
    near = [sized.select("label", (F.col("class") - step).alias("class"), F.col("blocks").alias(name)) for step, name in ((1, "above"), (-1, "below"))]
    sized = sized.join(near[0], ["label", "class"], "left").join(near[1], ["label", "class"], "left")
    # a set alone in its component meets nothing
    sized = sized.filter((F.col("members") > 1) | F.col("above").isNotNull() | F.col("below").isNotNull())
    own = own.join(sized, ["label", "class"]).withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")))
    block, turns = F.col("block"), lambda of: F.sequence(F.lit(0).cast("long"), F.col(of) - 1)

    def meeting(up: Column, first: Column, second: Column, side: Column) -> Column:
        return F.struct(up.alias("up"), first.alias("first"), second.alias("second"), side.cast("int").alias("side"))

    none = F.array().cast("array<struct<up:boolean,first:bigint,second:bigint,side:int>>")
    same = F.transform(turns("blocks"), lambda v: meeting(F.lit(False), F.least(block, v), F.greatest(block, v), block > v))
    higher = F.transform(turns("above"), lambda v: meeting(F.lit(True), block, v, F.lit(0)))
    lower = F.transform(turns("below"), lambda v: meeting(F.lit(True), v, block, F.lit(1)))
    met = own.select("label", "class", "key", "n", "copies", "hashes", F.explode(F.concat(same, F.coalesce(higher, none), F.coalesce(lower, none))).alias("m"))
    low = F.col("class") - F.when(F.col("m.up") & (F.col("m.side") == 1), 1).otherwise(0)
    met = met.select("label", low.alias("low"), "m.up", "m.first", "m.second", "m.side", (~F.col("m.up") & (F.col("m.first") == F.col("m.second"))).alias("within"), "key", "n", "copies", "hashes")
    sums = met.groupBy("label", "low", "up", "first", "second").applyInArrow(_link_sums(least), "key binary, n_links long")
    return sums.groupBy("key").agg(F.sum("n_links").alias("n_links"))


def _named(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """key, id, copies, label of every set of the documents; sets outside the candidates are components of their own."""
    sets = rows.filter("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("copies"))
    return sets.join(labels.withColumnRenamed("node", "key"), "key", "left").withColumn("label", F.coalesce("label", "key"))


def ngram_join(docs: DataFrame, width: int = WIDTH, least: int = LEAST) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest id reachable by links), n_links and n_equal of every document.

    n_links counts the other documents of similar but different sets, n_equal those of the same set.
    """
    rows = written(document_sets(docs, width), "ngram-documents")
    sets = candidate_sets(docs, width, least)
    labels = written(similar_sets(sets, least), "ngram-components")
    named = _named(rows, labels)
    smallest = named.groupBy("label").agg(F.min("id").alias("component_id"))
    linked = link_counts(sets, named, least)
    named = named.join(smallest, "label").join(linked, "key", "left").select("key", "component_id", "n_links", "copies")
    out = rows.join(named, "key", "left")
    own = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    zero = F.lit(0).cast("long")
    return out.select(
        "doc_id", "n_shingles", own.alias("component_id"),
        F.coalesce("n_links", zero).alias("n_links"), F.coalesce(F.col("copies") - 1, zero).alias("n_equal"),
    )


def _with_keys(docs: DataFrame, width: int) -> DataFrame:
    """row, key: whole rows with the name of their set (null for an empty set)."""
    row = T.StructType([T.StructField("row", docs.schema), T.StructField("key", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(shingle_sets(batch.column("text"), width))
            keys = [k.tobytes() if len(s) else None for k, s in zip(_keyed(sets), sets)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(keys, pa.binary())], ["row", "key"])

    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), column(docs, "text", "string").alias("text"))
    return own.mapInArrow(run, row)


def deduplicated(docs: DataFrame, width: int = WIDTH, least: int = LEAST) -> DataFrame:
    """One document of each component stays, the one with the smallest id; repeated rows of it are one.

    Null ids come last, equal ids are decided by the name of the set, then by the shorter text. What stays is
    chosen by component, so documents that aren't linked all stay, also with null or equal ids. Documents without words link
    with nothing and all stay.
    """
    rows = written(document_sets(docs, width), "ngram-documents")
    named = _named(rows, similar_sets(candidate_sets(docs, width, least), least))
    first = F.min(F.struct(F.col("id").isNull().alias("last"), F.col("id"), F.col("key"))).alias("first")
    stays = named.groupBy("label").agg(first).select(F.col("first.key").alias("key"), F.col("first.id").alias("_id"))
    own = _with_keys(docs, width)
    kept = own.join(stays, "key").filter(F.col("row.doc_id").cast("long").eqNullSafe(F.col("_id")))
    # a key names one component: what is left of it are repeated rows and other spellings under the same id
    kept = kept.groupBy("key").agg(F.min_by("row", F.struct(F.length("row.text"), F.col("row.text"))).alias("row"))
    empty = docs.filter(~F.coalesce(has_word(column(docs, "text", "string")), F.lit(False)))
    return kept.select("row.*").unionByName(empty)
