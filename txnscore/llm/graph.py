"""Distributed union-find and candidate stars on edge tables of integer ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import cut, discard

#: Values of fixed-width columns that may be broadcast (8 bytes each: 36 MB); beyond it, a shuffle join.
MAX_BROADCAST_VALUES = 4_500_000


def checked(rows: DataFrame, side: DataFrame | None = None, columns: int = 3) -> DataFrame:
    """Hint a broadcast of ``side`` (default: ``rows``) when ``rows``, a materialized table of at most
    ``columns`` fixed-width columns that ``side`` is made of, is counted to be small enough."""
    side = rows if side is None else side
    return F.broadcast(side) if rows.count() * columns <= MAX_BROADCAST_VALUES else side


def _large_star(edges: DataFrame, side) -> DataFrame:
    """Tie every larger neighbour of a node to the node's smallest neighbour (itself included)."""
    both = edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("x")).select("x.*")
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(side(low), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame, side) -> DataFrame:
    """Tie a node and its smaller neighbours to the smallest of them; edges point down (a > b)."""
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    # a node is tied to the smallest one itself, its other smaller neighbours too
    return (edges.join(side(low), "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
            .distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """Connected components of an undirected edge table (a, b) of non-null bigints.

    Alternating large-star / small-star rounds: every round is a few joins and partial
    aggregations, is materialized in the shared checkpoint folder, and leaves at most as many
    edges as before; it ends when a round changes nothing, i.e. when all trees are stars. The
    driver only sees a count and a checksum. Returns (node, component) for every node with an
    edge, the component being its smallest node.
    """
    edges = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                .filter("a > b").distinct())
    state = _state(edges)
    while state[0]:
        # a round never makes more edges, so that the edges counted before bound the nodes' minima
        side = F.broadcast if 4 * state[0] <= MAX_BROADCAST_VALUES else (lambda low: low)
        before, edges = edges, cut(_small_star(_large_star(edges, side), side))
        discard(before)
        after = _state(edges)
        if after == state:
            break
        state = after
    return edges.select(F.explode(F.array("a", "b")).alias("node"), F.col("b").alias("component")).distinct()


def shared_buckets(rows: DataFrame) -> DataFrame:
    """Rows (key, id) of the buckets that hold two or more distinct ids, with the bucket's
    smallest id as ``head``.

    The bucket heads come from a partially aggregated group-by, and the rows meet them in a plain
    equi join, so that a hot bucket is neither gathered in one group nor paired with itself. Most
    buckets hold one id, so the heads are often few enough for a broadcast.
    """
    heads = cut(rows.groupBy("key").agg(F.min("id").alias("head"), F.max("id").alias("tail"))
                .filter("head < tail").drop("tail"))
    return rows.join(checked(heads), "key")


def unshared(sets: DataFrame) -> DataFrame:
    """(id, alone): how many items of a set occur in no other set (ids without one are left out)."""
    return (sets.select("id", F.explode("items").alias("item"))
            .groupBy("item").agg(F.min("id").alias("id"), F.max("id").alias("last"))
            .filter("id = last").groupBy("id").agg(F.count(F.lit(1)).alias("alone")))


#: Items in at most so many sets are compared one by one in the bound below.
RARE = 64


def _bounds(sets: DataFrame, percent: int) -> DataFrame:
    """(id, n, rare, common) of the sets that can reach the threshold at all: the items found in two
    to ``RARE`` sets, and the number of those found in more."""
    items = sets.select("id", F.explode("items").alias("item"))
    # both uses of this table read all its columns, so that one exchange serves them
    used = items.groupBy("item").agg(F.count(F.lit(1)).alias("uses"), F.min("id").alias("id"))
    alone = used.filter("uses = 1 and id is not null").groupBy("id").agg(F.count(F.lit(1)).alias("alone"))
    rare = used.filter(f"uses between 2 and {RARE} and id is not null").select("item")
    listed = items.join(rare, "item").groupBy("id").agg(F.collect_list("item").alias("rare"))
    known = (sets.select("id", "n").join(alone, "id", "left").join(listed, "id", "left")
             .select("id", "n", F.coalesce("rare", F.array().cast("array<bigint>")).alias("rare"),
                     (F.col("n") - F.coalesce("alone", F.lit(0))).alias("shared")))
    return (known.filter(100 * F.col("shared") >= percent * F.col("n"))
            .select("id", "n", "rare", (F.col("shared") - F.size("rare")).alias("common")))


def cross_pairs(placed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of one bucket that could still join two components.

    ``placed`` has (key, id, comp), the component of each member; ``sets`` has (id, n, items). Members
    outside their bucket's largest component meet the members of other components. A pair is
    formed only if its common rare items plus the smaller number of frequent items, an upper bound
    of the intersection, reach the threshold; pairs inside a component are never formed. This keeps
    a large group of edited copies, whose members share most items, from being paired up.
    """
    main = (placed.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("members"))
            .groupBy("key").agg(F.max_by("comp", F.struct("members", "comp")).alias("main"),
                                F.count(F.lit(1)).alias("comps"))
            .filter("comps > 1").drop("comps"))
    split = cut(placed.join(main, "key"))
    ids = cut(split.select("id").distinct())
    split = cut(split.join(_bounds(sets.join(checked(ids), "id", "left_semi"), percent), "id"))
    side = lambda c, *more: ["key", *[F.col(x).alias(f"{c}_{x}") for x in ("id", "n", "rare", "common", "comp")], *more]
    least = F.least("a_common", "b_common")
    reach = lambda common: similar(common, F.col("a_n"), F.col("b_n"), percent)
    met = split.filter("comp <> main").select(*side("a")).join(split.select(*side("b", "main")), "key").filter(
        (F.col("a_comp") != F.col("b_comp")) & ((F.col("b_comp") == F.col("main")) | (F.col("a_id") < F.col("b_id")))
        & reach(least + F.least(F.size("a_rare"), F.size("b_rare")))
        & reach(least + F.size(F.array_intersect("a_rare", "b_rare"))))
    return met.select(F.col("a_id").alias("a"), F.col("b_id").alias("b")).distinct()


def similar(common: Column, size_a: Column, size_b: Column, percent: int) -> Column:
    """100 * intersection >= percent * union."""
    return 100 * common >= percent * (size_a + size_b - common)
