"""MinHash near-dedup with tensored banding, verified on full shingle sets.

A table key is a pair (a_i, b_j) from two collections of ``collections`` short keys, each made of ``rows`` minima:
``collections**2`` tables from 2 * collections * rows hash functions instead of that many per table. A pair of sets of
similarity s misses all tables with probability at most 2 * (1 - s**rows)**collections: 9e-5 at s = 0.8 and 3e-6 at
0.85 with the defaults.

Steps, none of which puts a group into one task or lists all pairs of a group:
1. one signature per document; equal sets become one class, named by its smallest id;
2. a short key that only one class has can be in no shared table: only shared short keys are combined;
3. a shingle that no other candidate has counts against every pair: with ``m`` the smaller number of shared shingles
   of two sets, their similarity is at most m / (sum of sizes - m);
4. each member of a bucket is compared with one central member of its buckets, which connects most copies of a group;
5. what is not connected is joined by prefixes: with the shingles of a set ordered by rarity, two similar sets share one
   of their first n - ceil(s * n) + 1. A shingle that one component holds alone gives no pair, of a shingle of several
   components the members beyond the largest meet the others, and sizes and places in the order rule out pairs before
   any set is looked at. So template text never meets, and copies that are connected are not compared again;
6. verified links join components by alternating large and small stars, so that any two linked texts share one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relfeat.llm.common import Words, byte_class, keyed, likely, mixed, shingle_hashes, slices, small_batches, stored

# anything but ASCII white space
WORD = ~byte_class((9, 13), (32, 32))
SIGNATURE = "doc_id LONG, text_key LONG, n LONG, digest BINARY, a ARRAY<LONG>, b ARRAY<LONG>"


def shingle_sets(column: pa.Array, words_each: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row; a row with fewer words is one shingle, one without words is empty."""
    words = Words(column, WORD)
    hashes = shingle_hashes(words.hashes, words_each)
    sets = []
    for first, end in zip(words.first.tolist(), words.first[1:].tolist()):
        n = end - first
        if n >= words_each:
            sets.append(np.unique(hashes[first : end - words_each + 1]))
        else:  # marked by its length, so that it equals no shingle of a longer text
            sets.append(shingle_hashes(words.hashes[first:end], n) ^ np.uint64(n) if n else np.empty(0, np.uint64))
    return sets


def multipliers(n: int) -> np.ndarray:
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def signatures(words_each: int, rows: int, collections: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = multipliers(2 * rows * collections)
        for batch in slices(batches, "text"):
            sets = shingle_sets(batch.column("text"), words_each)
            sizes = np.array([len(s) for s in sets], np.int64)
            full = np.flatnonzero(sizes)
            keys = np.zeros((len(sets), 2 * collections), np.uint64)
            if len(full):
                flat = np.concatenate([sets[i] for i in full])
                begin = np.cumsum(sizes[full]) - sizes[full]
                for k in range(2 * collections):
                    key = np.zeros(len(full), np.uint64)
                    for factor in factors[k * rows : (k + 1) * rows]:
                        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + np.minimum.reduceat(flat * factor, begin))
                    keys[full, k] = key
            parts = []
            for half in (keys[:, :collections], keys[:, collections:]):
                ends = np.arange(0, collections * len(sets) + 1, collections, dtype=np.int32)
                parts.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(half.ravel().view(np.int64))))
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(sizes), pa.array(digests, pa.binary()), *parts],
                ["doc_id", "text_key", "n", "digest", "a", "b"],
            )

    return sign


def full_sets(words_each: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = shingle_sets(batch.column("text"), words_each)
            ends = np.concatenate([[0], np.cumsum([len(s) for s in found])]).astype(np.int32)
            flat = np.concatenate([*found, np.empty(0, np.uint64)]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["id", "shingles"]
            )

    return sets


def near_dedup(
    docs: DataFrame,
    words_each: int = 5,
    similar: tuple[int, int] = (4, 5),
    rows: int = 3,
    collections: int = 14,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_key, n_shingles, component_id, kept.

    Sets of ``words_each``-word shingles (A-Z lower-cased, words split at ASCII white space) are linked when their
    Jaccard similarity is at least ``similar``; ``component_id`` is the smallest id reachable over links, itself
    included, and the row with that id is kept. Texts without words, NULL among them, are linked with nothing. A NULL
    id is linked with nothing, has no component and is kept. Rows that repeat an id are one document.
    """
    small_batches(docs.sparkSession)
    texts = keyed(docs, id_col, text_col)
    signed = stored(texts.mapInArrow(signatures(words_each, rows, collections), SIGNATURE), "signatures")
    usable = signed.where("doc_id IS NOT NULL AND n > 0")
    classes = stored(usable.groupBy("digest").agg(F.min("doc_id").alias("class_id")), "classes")
    one_each = usable.join(classes.withColumnRenamed("digest", "d"), (F.col("digest") == F.col("d")) & (F.col("doc_id") == F.col("class_id")))
    members = shared_buckets(one_each.select("class_id", "n", "a", "b"))
    # the few sets of others that a bitmap lets through only make bounds weaker: they are in no bucket and no pair
    wanted = likely(texts.select("doc_id", "text"), "doc_id", stored(members.select("id").distinct(), "member-ids"))
    sets = stored(wanted.mapInArrow(full_sets(words_each), "id LONG, shingles ARRAY<LONG>"), "sets")
    found = components(members, sets, similar)
    return (
        signed.join(classes, "digest", "left")
        .join(found.withColumnRenamed("id", "class_id"), "class_id", "left")
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "class_id", "doc_id")))
        .select("doc_id", "text_key", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
    )


def shared_buckets(classes: DataFrame) -> DataFrame:
    """``key, id, n``: the members of each distinct bucket that holds at least two classes."""
    short = classes.select(F.col("class_id").alias("id"), "n", F.posexplode(F.concat("a", "b")).alias("slot", "h"), F.size("a").alias("m"))
    short = stored(short, "short-keys")
    again = short.groupBy("slot", "h").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("slot", "h")
    shared = stored(short.join(again, ["slot", "h"]), "short-shared")
    a = shared.where("slot < m").select("id", "n", F.xxhash64("slot", "h").alias("ha"))
    b = shared.where("slot >= m").select("id", F.xxhash64("slot", "h").alias("hb"))
    tables = stored(a.join(b, "id").select("id", "n", F.xxhash64("ha", "hb").alias("key")).distinct(), "tables")
    code = F.xxhash64("id")
    alike = [F.count(F.lit(1)).alias("c"), F.sum(F.shiftright(code, 32)).alias("s"), F.bit_xor(code).alias("x"), F.min("id").alias("low")]
    buckets = tables.groupBy("key").agg(*alike).where("c > 1")
    chosen = buckets.groupBy("c", "s", "x", "low").agg(F.min("key").alias("key")).select("key")
    return stored(tables.join(chosen, "key"), "members")


def able(similar: tuple[int, int], n: str = "n", c: str = "c", pn: str = "pn", pc: str = "pc") -> str:
    """Whether sizes and shared shingles allow a pair to be similar."""
    num, den = similar
    return f"{den} * least({c}, {pc}) >= {num} * ({n} + {pn} - least({c}, {pc}))"


def components(members: DataFrame, sets: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """``id, component`` of every member of a bucket."""
    prefixes, shared = rare_prefixes(sets, similar)
    pairs = stored(central_pairs(members, shared, similar), "central-pairs")
    links = stored(similar_pairs(pairs, sets, similar), "links")
    labels = relabel(members.select("id").distinct().withColumn("component", F.col("id")), links)
    pairs = stored(prefix_pairs(prefixes, labels, similar), "pairs")
    return relabel(labels, stored(similar_pairs(pairs, sets, similar), "links"))


def rare_prefixes(sets: DataFrame, similar: tuple[int, int]) -> tuple[DataFrame, DataFrame]:
    """``id, n, place, shingle``: the part of each set's prefix that another candidate has too, in the order of rarity,
    with the number of shingles before it; and ``id, c``: the number of shared shingles of each set that can be linked."""
    num, den = similar
    every = sets.select("id", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    counts = every.groupBy("shingle").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    order = F.array_sort(F.collect_list(F.struct("k", "shingle"))).alias("rare")
    listed = every.join(counts, "shingle").groupBy("id", "n").agg(order)
    listed = listed.select("id", "n", F.size("rare").alias("c"), F.expr(f"n - CAST(ceil({num} * n / {den}) AS INT) + 1 AS size"), "rare")
    # shingles of its own come first in any order: they take up the first n - c places
    listed = listed.select("id", "n", "c", F.expr("slice(rare, 1, greatest(size - (n - c), 0)) AS rare"))
    listed = stored(listed.where("size(rare) > 0"), "prefixes")
    placed = listed.select("id", "n", "c", F.posexplode("rare").alias("at", "r"))
    return placed.select("id", "n", F.expr("n - c + at AS place"), "r.shingle"), listed.select("id", "c")


def central_pairs(members: DataFrame, shared: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """For each id one member of its buckets: of the most central ones of all its buckets, those with the fewest shingles
    of their own, the first; ties by hash. One row per member of a bucket, one pair per id."""
    known = members.join(shared, "id").select("key", "id", "n", "c")
    order = F.struct((F.col("n") - F.col("c")).alias("own"), F.xxhash64("id").alias("h"), "id", "n", "c")
    heads = known.groupBy("key").agg(F.min(order).alias("head"))
    both = known.join(heads, "key").where(f"id <> head.id AND {able(similar, pn='head.n', pc='head.c')}")
    chosen = both.groupBy("id").agg(F.min("head").alias("head"))
    return chosen.select(F.least("id", "head.id").alias("x"), F.greatest("id", "head.id").alias("y")).distinct()


def prefix_pairs(prefixes: DataFrame, labels: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """The pairs of different components that share a shingle of their prefixes and may be similar by size and place."""
    num, den = similar
    rows = stored(prefixes.join(labels, "id"), "labelled-prefixes")
    sizes = rows.groupBy("shingle", "component").agg(F.count(F.lit(1)).alias("own"))
    top = sizes.groupBy("shingle").agg(F.max(F.struct("own", "component")).alias("top"), F.sum("own").alias("all"))
    top = top.where("top.own < all").select("shingle", F.col("top.component").alias("largest"))
    open_rows = rows.join(top, "shingle")
    outside = open_rows.where("component <> largest").select("shingle", F.col("id").alias("x"), F.col("n").alias("nx"), F.col("place").alias("px"), F.col("component").alias("cx"))
    others = open_rows.select("shingle", F.col("id").alias("y"), F.col("n").alias("ny"), F.col("place").alias("py"), F.col("component").alias("cy"), "largest")
    # at the first shingle that both prefixes have, no more than the rest of the shorter side can follow
    common = "least(nx - px, ny - py)"
    fits = f"{den} * ({common}) >= {num} * (nx + ny - ({common}))"
    pairs = outside.join(others, "shingle").where(f"cx <> cy AND (cy = largest OR x < y) AND {fits}")
    return pairs.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()


def similar_pairs(pairs: DataFrame, sets: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """The stored pairs ``x < y`` whose full sets are similar; only sets of these pairs move."""
    num, den = similar
    ends = pairs.select(F.explode(F.array("x", "y")).alias("id")).distinct()
    sets = likely(sets, "id", stored(ends, "pair-ends"))
    left = sets.select(F.col("id").alias("x"), F.col("shingles").alias("sx"))
    right = sets.select(F.col("id").alias("y"), F.col("shingles").alias("sy"))
    both = pairs.join(left, "x").join(right, "y").select("x", "y", F.size("sx").alias("nx"), F.size("sy").alias("ny"), F.size(F.array_intersect("sx", "sy")).alias("common"))
    return both.where(f"CAST({den} AS BIGINT) * common >= {num} * (nx + ny - common)").select("x", "y").distinct()


def relabel(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Merge components that a link connects; the new name is the smallest id."""
    a, b = labels.toDF("x", "cx"), labels.toDF("y", "cy")
    edges = links.join(a, "x").join(b, "y").where("cx <> cy").select(F.greatest("cx", "cy").alias("u"), F.least("cx", "cy").alias("v")).distinct()
    roots = star_components(edges)
    if roots is None:
        return stored(labels, "labels")
    joined = labels.join(roots.toDF("component", "root"), "component", "left")
    return stored(joined.select("id", F.coalesce("root", "component").alias("component")), "labels")


def star_components(edges: DataFrame) -> DataFrame | None:
    """``u, root`` for every node that is not the smallest of its component, from edges ``u > v``; None without edges.

    Large star: every larger neighbour of a node is linked to the smallest neighbour. Small star: every smaller one.
    Both keep components and shrink paths; at rest each node is linked to its root only, which is seen from the edges:
    no node has two and no root has one.
    """
    edges = stored(edges, "edges")
    if edges.isEmpty():
        return None
    while not at_rest(edges):
        around = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = around.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.toDF("u", "v")).where("u > v").distinct()
        edges = stored(small, "stars")
    return edges.toDF("u", "root")


def at_rest(edges: DataFrame) -> bool:
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR (up > 0 AND down > 0)").isEmpty()
