"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a shuffled order, repeated up to ``epochs`` times. A
copy's virtual finish time is its source's cumulative words, itself included, divided by the
source's target. The copies of all sources are range-sorted by finish time and cut off at the total
budget, so each source takes close to its target whatever its number of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import checked
from .order import row_numbers, running_sums
from .tables import cut, word_count

WEIGHTS = (1, 2, 3)
SEED = 17


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, epochs: int = 3) -> DataFrame:
    """Targets of (source, source_size): adds ``rank`` and ``target``.

    Sources by code point, null last, take the weights in turn and share the total size; a target
    stops at ``epochs`` times its source's size, and the excess is shared again by weight until no
    target is above. Each round is one aggregate over the table of sources; the driver sees one row.
    """
    ranked = row_numbers(sizes, [F.col("source").asc_nulls_last()], "rank").withColumn("rank", F.col("rank") - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = cut(ranked.withColumn("weight", weight))
    cap = F.lit(float(epochs)) * F.col("source_size")
    level = 0.0
    while True:
        full = cap <= F.col("weight") * F.lit(level)
        row = ranked.agg(F.sum("source_size").alias("total"), F.sum(F.when(full, cap)).alias("capped"),
                         F.sum(F.when(~full, F.col("weight"))).alias("open")).first()
        raised = ((row["total"] or 0) - (row["capped"] or 0.0)) / row["open"] if row["open"] else level
        if raised <= level:  # the level only ever rises, but for rounding
            break
        level = raised
    return ranked.withColumn("target", F.least(cap, F.col("weight") * F.lit(level))).drop("weight")


#: What tells documents apart; rows that agree in all of it are copies of one document.
DOCUMENT = ["doc_id", "source", "tx"]


def shares(docs: DataFrame, weights: tuple = WEIGHTS, epochs: int = 3, seed: int = SEED) -> DataFrame:
    """One row per distinct (doc_id, source, text): doc_id, source, tx (hash of the text), n_rows, size,
    source_size, target and copies (how many times each of its rows is read). See ``mix``."""
    base = docs.select("doc_id", F.col("source").cast("string").alias("source"), F.xxhash64(F.col("text").cast("string")).alias("tx"),
                       word_count(F.col("text").cast("string")).alias("size"))
    # equal rows queue as one, so that they are taken or left together
    base = base.groupBy(*DOCUMENT).agg(F.max("size").alias("size"), F.count(F.lit(1)).alias("n_rows"))
    of_id = F.col("doc_id").cast("string")
    shuffle = F.when(of_id.isNull(), F.xxhash64(F.lit(seed), F.lit(""), "tx")).otherwise(F.xxhash64(F.lit(seed), of_id))
    base = cut(base.withColumn("words", F.col("size") * F.col("n_rows")).withColumn("shuffle", shuffle)
               .withColumn("name", F.coalesce(of_id, F.lit(""))))
    sources = cut(source_targets(base.groupBy("source").agg(F.sum("words").alias("source_size")), weights, epochs))
    # running words per source: along (source, shuffle) globally, minus the words of earlier sources
    starts = running_sums(sources, [F.col("rank")], ["source_size"], "upto_")
    known = base.join(starts.select(F.col("source").alias("s"), "rank", "source_size", "target",
                                    (F.col("upto_source_size") - F.col("source_size")).alias("skipped")),
                      F.col("source").eqNullSafe(F.col("s"))).drop("s")
    ties = ["shuffle", "name", "tx"]
    line = cut(running_sums(known.filter("size > 0"), [F.col("rank"), *map(F.col, ties)], ["words"], "cum_"))
    # equal rows stand where the first of them ends
    begin = F.col("cum_words") - F.col("words") + F.col("size")
    finish = lambda copy: (begin - F.col("skipped") + copy * F.col("source_size")) / F.col("target")
    each = (line.select(*ties, "size", "words", "cum_words", "skipped", "source_size", "target",
                        F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("copy")).withColumn("finish", finish(F.col("copy"))))
    budget = F.lit(base.agg(F.sum("words")).first()[0] or 0)
    place = ["finish", *ties, "copy"]
    queue = running_sums(each.select(*place, "words"), [F.col(c) for c in place], ["words"], "cum_")
    last = queue.filter(F.col("cum_words") <= budget).agg(F.max(F.struct(*place)).alias("last")).first()["last"]
    if last is None:
        within = lambda copy: F.lit(False)
    else:
        cutoff = F.struct(*[F.lit(last[c]).alias(c) for c in place])
        within = lambda copy: F.struct(finish(F.lit(copy)).alias("finish"), *ties, F.lit(copy).alias("copy")) <= cutoff
    n = sum((within(k).cast("long") for k in range(epochs)), F.lit(0).cast("long"))
    columns = [*DOCUMENT, "n_rows", "size", "source_size", "target"]
    return line.select(*columns, n.alias("copies")).union(known.filter("size = 0").select(*columns, F.lit(0).cast("long").alias("copies")))


def mix(docs: DataFrame, weights: tuple = WEIGHTS, epochs: int = 3, seed: int = SEED) -> DataFrame:
    """One row per input row: doc_id, source, size, source_size, target, copies and taken.

    size: words of the text (0 for null or empty); taken = copies * size. A null source is a source
    of its own. Rows of one doc_id and source with equal texts are copies of one document and are taken
    or left together; rows with different texts, and rows with a null doc_id by their texts, are documents of their
    own. Documents without words take nothing and have no copies. An empty table gives no rows. Reruns
    agree: the shuffle is a hash of the id (of the text where the id is null). Ids may be of any type.
    """
    rows = F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_rows")))
    out = shares(docs, weights, epochs, seed).select("doc_id", "source", "size", "source_size", "target", "copies", rows.alias("__row"))
    return out.drop("__row").withColumn("taken", F.col("copies") * F.col("size"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the mix takes, with size, source_size, target, copies and taken."""
    new = ["size", "source_size", "target", "copies", "taken"]
    # two hashes of what tells documents apart: a table of fixed width, broadcast if it is counted to be small
    key = lambda tx: [F.xxhash64(F.lit(k), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("doc_id").isNull(),
                                 F.coalesce(F.col("source").cast("string"), F.lit("")), F.col("source").isNull(), tx).alias(f"__k{k}") for k in (1, 2)]
    taken = cut(shares(docs, **options).filter("copies > 0").withColumn("taken", F.col("copies") * F.col("size")).select(*key(F.col("tx")), *new))
    named = docs.drop(*new).select("*", *key(F.xxhash64(F.col("text").cast("string"))))
    return named.join(checked(taken, columns=7), ["__k1", "__k2"]).drop("__k1", "__k2")
