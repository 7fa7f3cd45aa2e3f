"""MinHash near-dedup with tensored banding.

A document's set is its distinct word shingles (A-Z lower-cased, as 64-bit hashes). Documents
with equal sets form a class and only its smallest id goes on. Each class has ``collections``
small MinHash collections of ``half`` values; the key of a table combines two collections, so
``collections * half`` MinHash computations feed ``collections * (collections - 1) / 2`` tables of
``2 * half`` values each. A pair of similarity s meets unless fewer than two of its collections
agree: with 12 x 3 and s = 0.85 it is missed with probability 2e-4, with 12 x 2 and s = 0.8 with 1e-4.

Candidates are verified on full sets, without ever pairing all members of a bucket:

1. Documents in shared buckets whose share of shingles found in any other such document is below
   the threshold cannot link and leave (exact bound).
2. Every member is verified against the member of its buckets that has the fewest shingles of its own
   (the least edited copy); links give components.
3. In buckets that still hold several components, members outside the bucket's largest one are
   verified against the members of other components, if the sizes and unshared shingles allow a
   link (exact bound). Pairs inside a component need no check: they cannot change the result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .graph import checked, components, cross_pairs, shared_buckets, similar, unshared
from .tables import cut


def _seeds(n: int) -> np.ndarray:
    return np.random.RandomState(1729).randint(1, 1 << 31, size=2 * n, dtype=np.int64).astype(np.uint32) * np.uint32(2) + np.uint32(1)


def minhashes(values: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """``n`` MinHash values (uint32) of each set of 64-bit hashes; an empty set gets zeros."""
    low, high = values.astype(np.uint32), (values >> np.uint64(32)).astype(np.uint32)
    seeds = _seeds(n)
    out = np.empty((len(offsets) - 1, n), np.uint32)
    for i in range(n):
        out[:, i] = tb.group_reduce(np.minimum, low * seeds[2 * i] + (high ^ seeds[2 * i + 1]) * seeds[2 * i + 1], offsets, 0)
    return out


def signatures(docs: DataFrame, shingle: int, n_hashes: int) -> DataFrame:
    """Per document: set size, two 64-bit set digests, and the MinHash values as bytes."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for s in tb.slices(batch.column(1)):
                values, offsets = tb.word_shingles(s, shingle)
                sig = minhashes(values, offsets, n_hashes)
                mixed = tb.mix(values + np.uint64(0x632BE59BD9B4E019))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(s.first, s.n), pa.array(np.diff(offsets)),
                     pa.array(tb.group_reduce(np.bitwise_xor, mixed, offsets, 0).view(np.int64)),
                     pa.array(tb.group_reduce(np.add, mixed * mixed, offsets, 0).view(np.int64)),
                     pa.array([row.tobytes() for row in sig], pa.binary())],
                    names=["doc_id", "n", "d1", "d2", "sig"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, n long, d1 long, d2 long, sig binary"))


def table_keys(sigs: DataFrame, half: int, collections: int) -> DataFrame:
    """(key, id) rows: one per document and pair of collections."""
    pairs = np.array(list(combinations(range(collections), 2)))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                ids = part.column(0).to_numpy()
                raw = b"".join(part.column(1).to_pylist())
                sig = np.frombuffer(raw, np.uint32).reshape(len(ids), collections, half).astype(np.uint64)
                small = np.zeros((len(ids), collections), np.uint64)
                for k in range(half):
                    small = tb.mix(small * np.uint64(0x9E3779B97F4A7C15) + sig[:, :, k])
                table = np.arange(len(pairs), dtype=np.uint64)
                keys = tb.mix(tb.mix(small[:, pairs[:, 0]] + table) + small[:, pairs[:, 1]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(ids, len(pairs)))], names=["key", "id"])

    return sigs.select("doc_id", "sig").mapInArrow(run, "key long, id long")


def shingle_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """(id, n, items): the full shingle set of each document as sorted 64-bit hashes."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for s in tb.slices(batch.column(1)):
                values, offsets = tb.word_shingles(s, shingle)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(s.first, s.n), pa.array(np.diff(offsets)), tb.lists(values, offsets)],
                    names=["id", "n", "items"])

    return (docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "id long, n long, items array<bigint>"))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets reach the threshold."""
    left = sets.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("items").alias("items_a"))
    right = sets.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("items").alias("items_b"))
    common = F.size(F.array_intersect("items_a", "items_b")).cast("long")
    return (pairs.join(left, "a").join(right, "b")
            .filter(similar(common, F.col("na"), F.col("nb"), percent)).select("a", "b"))


def links(buckets: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that give the same components as all links between members of one bucket.

    ``buckets`` has (key, id, head) rows of shared buckets, ``sets`` the (id, n, items) of their
    ids; both are materialized.
    """
    facts = (sets.select("id", "n").join(unshared(sets), "id", "left")
             .select("id", "n", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("shared"))
             .filter(100 * F.col("shared") >= percent * F.col("n")))
    facts = cut(facts)
    rows = shared_buckets(buckets.select("key", "id").join(facts, "id")).drop("head")
    # the member with the fewest items of its own is the most central one of a group of near copies
    heads = rows.groupBy("key").agg(F.min(F.struct((F.col("n") - F.col("shared")).alias("alone"), "id")).alias("h"))
    rows = cut(rows.join(heads.select("key", F.col("h.id").alias("head")), "key"))
    fact_of = lambda side: facts.select(F.col("id").alias(side), F.col("n").alias(f"n{side}"), F.col("shared").alias(f"s{side}"))

    def possible(df: DataFrame) -> DataFrame:
        most = F.least("sa", "sb")
        return df.filter(similar(most, F.col("na"), F.col("nb"), percent))

    stars = (rows.filter("id <> head").select(F.col("id").alias("a"), F.col("head").alias("b")).distinct()
             .join(fact_of("a"), "a").join(fact_of("b"), "b"))
    first = cut(verified(possible(stars).select("a", "b"), sets, percent))

    found = components(first)
    # pairs with a head are settled
    placed = rows.filter("id <> head").join(found.withColumnRenamed("node", "id"), "id", "left").select(
        "key", "id", F.coalesce("component", "id").alias("comp"))
    rest = cross_pairs(placed, sets, percent)
    second = verified(rest.join(first, ["a", "b"], "left_anti"), sets, percent)
    return first.union(second)


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, half: int = 2,
                    collections: int = 12) -> DataFrame:
    """Near-duplicate groups of ``docs`` (doc_id, text): one row per input row.

    Returns doc_id, n_shingles, component_id (smallest doc_id reachable over links of
    ``100 * intersection >= percent * union``, itself included) and kept (doc_id = component_id).

    Null, empty and blank texts have an empty set and link with nothing. Rows with a null doc_id
    take no part: component_id is null and kept true. Repeated rows each get their row; rows that
    share a doc_id but differ in their texts each stand for that id, so the groups of both texts become one if they link. An empty table gives no rows; other columns are ignored.
    """
    docs = docs.select("doc_id", "text")
    sigs = cut(signatures(docs, shingle, half * collections))
    known = sigs.filter("n > 0 and doc_id is not null")
    classes = known.groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("rep"))
    reps = known.join(classes.select(F.col("rep").alias("doc_id"), "d1", "d2", "n"), ["doc_id", "d1", "d2", "n"], "left_semi")
    buckets = cut(shared_buckets(table_keys(reps, half, collections)))
    ids = cut(buckets.select("id").distinct())
    sets = cut(shingle_sets(docs.join(checked(ids), F.col("doc_id") == F.col("id"), "left_semi"), shingle))
    found = components(links(buckets, sets, percent))
    labelled = (classes.join(found, F.col("rep") == F.col("node"), "left")
                .select("d1", "d2", "n", F.coalesce("component", "rep").alias("class_id")))
    out = sigs.join(labelled, ["d1", "d2", "n"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents whose group has a smaller id; repeated rows of a kept id
    become one row, the one whose columns hash smallest (if their texts differ, one of them stays); rows with a null
    id stay as they are."""
    kept = cut(near_duplicates(docs, **options).filter("kept and doc_id is not null")
               .groupBy(F.col("doc_id").alias("__id")).agg(F.count(F.lit(1)).alias("__n")))
    repeated = cut(kept.filter("__n > 1").select("__id"))
    on = F.col("doc_id") == F.col("__id")
    named = docs.join(checked(kept, kept.select("__id")), on, "left_semi")
    twice = checked(repeated)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    # only rows of repeated ids are aggregated by id
    return (named.join(twice, on, "left_anti").union(named.join(twice, on, "left_semi").groupBy("doc_id")
                                                  .agg(F.min_by(F.struct(*columns), F.xxhash64(*columns)).alias("row")).select("row.*"))
            .union(docs.filter(F.col("doc_id").isNull())))
