"""Aggregations: class counts and weights (AG1, AG3, FE9), batch KPIs (AG2, AG4, AG5) and the
cumulative ``le`` histogram (AG6). All are partial + final hash aggregates; joins back to rows
only ever broadcast tables whose row count is bounded by construction."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import approval_rate
from ..schema import DURATION_BUCKETS, LABEL


def class_counts(df: DataFrame, label: str = LABEL) -> DataFrame:
    """AG1: rows per class."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def class_weight_table(df: DataFrame, label: str = LABEL, normalize: bool = False) -> DataFrame:
    """AG3: weight_c = N / n_c (or N / (k * n_c) with ``normalize``), one row per class.

    Every label value is a class, whatever its number. N counts every row with a non-null label,
    as the reference's total does.
    """
    counts = (df.where(F.col(label).isNotNull()).groupBy(label)
              .agg(F.count(F.lit(1)).alias("n_class")))
    # The class table has one row per distinct label value (the classes), so a window over all
    # of it is bounded; computing N this way costs no extra scan of the data.
    everything = Window.partitionBy()
    total = F.sum("n_class").over(everything)
    k = F.count(F.lit(1)).over(everything) if normalize else F.lit(1)
    return counts.select(label, (total.cast("double") / (k * F.col("n_class"))).alias("weight"))


def with_class_weights(df: DataFrame, label: str = LABEL, normalize: bool = False, weight_col: str = "weight") -> DataFrame:
    """FE9 / JN2: attach ``weight`` by an inner join on the label; rows with a null label drop
    out as in the reference. The weight table has one row per class (two fixed-width columns), so
    broadcasting it is safe and the big side is never shuffled on a two-valued key."""
    w = class_weight_table(df, label, normalize).withColumnRenamed("weight", weight_col)
    return df.join(F.broadcast(w), [label], "inner")


def batch_kpis(df: DataFrame, fraud_col: str = "predicted_fraud", high_risk_col: str = "is_high_risk",
               group_cols: list[str] | None = None) -> DataFrame:
    """AG2/AG4/AG5: batch size, fraud count, high-risk count and approval rate in one pass."""
    aggs = [F.count(F.lit(1)).alias("n"),
            F.count_if(F.col(fraud_col)).alias("n_fraud"),
            F.count_if(F.col(high_risk_col)).alias("n_high_risk")]
    out = df.groupBy(*(group_cols or [])).agg(*aggs)
    return out.withColumn("approval_rate", approval_rate("n", "n_fraud"))


def bucket_labels(buckets: list[float]) -> list[str]:
    return [repr(float(b)) for b in buckets] + ["+Inf"]


def histogram_le(df: DataFrame, value_col: str, buckets: list[float] = DURATION_BUCKETS) -> DataFrame:
    """AG6: cumulative ``le`` buckets with total sum and count (cumulative-bucket histogram layout).

    Rows are reduced to one count per bucket by a hash aggregate; the cumulative sum then runs
    over the bucket table (len(buckets) + 1 rows), never over raw rows.
    """
    v = F.col(value_col)
    idx = None
    for i, b in enumerate(buckets):
        idx = F.when(v <= F.lit(b), F.lit(i)) if idx is None else idx.when(v <= F.lit(b), F.lit(i))
    idx = idx.otherwise(F.lit(len(buckets)))
    per_bucket = (df.where(v.isNotNull()).groupBy(idx.alias("bucket"))
                  .agg(F.count(F.lit(1)).alias("n"), F.sum(v).alias("s")))
    labels = bucket_labels(buckets)
    grid = df.sparkSession.range(len(labels)).select(
        F.col("id").cast("int").alias("bucket"),
        F.element_at(F.array(*[F.lit(x) for x in labels]), F.col("id").cast("int") + 1).alias("le"))
    # both sides have len(buckets) + 1 rows at most
    joined = grid.join(F.broadcast(per_bucket), "bucket", "left").fillna(0, ["n"])
    upto = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy()
    return joined.select(
        "le",
        F.sum("n").over(upto).cast("long").alias("cumulative_count"),
        F.coalesce(F.sum("s").over(everything), F.lit(0.0)).alias("value_sum"),
        F.sum("n").over(everything).cast("long").alias("value_count"),
        "bucket",
    )
