"""Ranks and running sums along a global order, without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import cut

PART, PLACE = "__part", "__place"


def sorted_parts(df: DataFrame, order: list[Column]) -> DataFrame:
    """``df`` range-sorted and materialized, with the number of the range (``PART``) and an
    increasing place in it (``PLACE``). The checkpoint pins which rows lie in which range."""
    return cut(df.orderBy(*order).withColumn(PART, F.spark_partition_id()).withColumn(PLACE, F.monotonically_increasing_id()))


def row_numbers(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Number (1, 2, ...) of every row in the order ``order``."""
    rows = sorted_parts(df, order)
    # one row per range, whatever the number of rows
    parts = rows.groupBy(PART).agg(F.count(F.lit(1)).alias("n"), F.min(PLACE).alias("first"))
    before = F.coalesce(F.sum("n").over(Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select(PART, (before - F.col("first") + 1).alias("shift"))
    return rows.join(F.broadcast(parts), PART).withColumn(name, (F.col(PLACE) + F.col("shift")).cast("long")).drop(PART, PLACE, "shift")


def running_sums(df: DataFrame, order: list[Column], columns: list[str], prefix: str) -> DataFrame:
    """Sums of ``columns`` over all rows up to and with each one in the order ``order``."""
    rows = sorted_parts(df, order)
    parts = rows.groupBy(PART).agg(*[F.sum(c).alias(c) for c in columns])
    earlier = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(PART, *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"__up_to_{c}") for c in columns])
    inside = Window.partitionBy(PART).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.join(F.broadcast(parts), PART).select(
        *df.columns, *[(F.col(f"__up_to_{c}") + F.sum(c).over(inside)).alias(prefix + c) for c in columns])


def group_positions(df: DataFrame, key: str, order: list[Column], name: str) -> DataFrame:
    """Position (0, 1, ...) of every row among those of its ``key``, in the order ``order``.

    The rows are range-sorted by key and order, so that a key with many rows spreads over several
    ranges; each range numbers its own rows and adds the key's rows in the ranges before.
    """
    rows = sorted_parts(df, [F.col(key), *order])
    n = rows.groupBy(key, PART).agg(F.count(F.lit(1)).alias("n"))
    earlier = F.sum("n").over(Window.partitionBy(key).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1))
    # only a range's first key can have begun in an earlier one: at most one row per range
    carried = cut(n.select(PART, key, earlier.alias("carried")).filter("carried is not null"))
    own = F.row_number().over(Window.partitionBy(PART, key).orderBy(PLACE)) - 1
    return (rows.withColumn(name, own).join(F.broadcast(carried), [PART, key], "left")
            .withColumn(name, (F.col(name) + F.coalesce("carried", F.lit(0))).cast("long")).drop(PART, PLACE, "carried"))
