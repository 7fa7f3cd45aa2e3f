"""Dashboard series re-expressed as DataFrame queries: RP1-RP10.

Rates are exact counts divided by the window length (no range-edge extrapolation). Every series
first reduces raw rows to one row per (series, time bucket) with a partial + final aggregate;
windows, lags and running sums then run over those bucket tables, partitioned by series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import approval_rate, epoch_seconds, ntz_from_epoch_seconds, threshold_band


def _ts_from_seconds(seconds: Column) -> Column:
    """Epoch seconds -> TIMESTAMP_NTZ (UTC wall clock), without the session time zone."""
    return ntz_from_epoch_seconds(seconds)


def bucket_counts(df: DataFrame, ts: str, bucket_seconds: int, counts: dict[str, Column],
                  keys: list[str] | None = None) -> DataFrame:
    """One row per (keys, bucket) with ``count_if`` of each condition in ``counts``."""
    b = F.floor(epoch_seconds(ts) / F.lit(bucket_seconds)).cast("long").alias("bucket")
    return df.groupBy(*(keys or []), b).agg(*[F.count_if(cond).alias(name) for name, cond in counts.items()])


def sliding_window_counts(df: DataFrame, ts: str, window_seconds: int, slide_seconds: int,
                          counts: dict[str, Column], keys: list[str] | None = None) -> DataFrame:
    """RP1: counts per sliding window [start, start + window), starts aligned to the epoch every
    ``slide_seconds`` (Spark ``window()`` semantics). Raw rows are counted once per slide bucket;
    only the bucket table is fanned out to the ``window/slide`` windows that contain it."""
    if window_seconds % slide_seconds:
        raise ValueError("window length must be a multiple of the slide")
    per = bucket_counts(df, ts, slide_seconds, counts, keys)
    span = window_seconds // slide_seconds
    fanned = per.withColumn("start", F.explode(F.sequence(F.col("bucket") - (span - 1), F.col("bucket"))))
    out = fanned.groupBy(*(keys or []), "start").agg(*[F.sum(n).cast("long").alias(n) for n in counts])
    return out.select(*(keys or []),
                      _ts_from_seconds(F.col("start") * slide_seconds).alias("window_start"),
                      _ts_from_seconds(F.col("start") * slide_seconds + window_seconds).alias("window_end"),
                      *counts)


def tumbling_window_counts(df: DataFrame, ts: str, window_seconds: int, counts: dict[str, Column],
                           keys: list[str] | None = None) -> DataFrame:
    """RP2: counts per tumbling window."""
    per = bucket_counts(df, ts, window_seconds, counts, keys)
    return per.select(*(keys or []),
                      _ts_from_seconds(F.col("bucket") * window_seconds).alias("window_start"),
                      _ts_from_seconds((F.col("bucket") + 1) * window_seconds).alias("window_end"),
                      *counts)


def with_rates(df: DataFrame, window_seconds: int, count_to_rate: dict[str, str]) -> DataFrame:
    """count / window length, per second."""
    return df.withColumns({rate: F.col(n) / F.lit(float(window_seconds)) for n, rate in count_to_rate.items()})


def rate_summary(per_bucket: DataFrame, count_col: str, bucket_seconds: int) -> DataFrame:
    """RP3: mean and max rate of a tumbling series over its full time grid (first to last bucket;
    empty buckets count as 0) plus the grid size. One aggregate over the bucket table."""
    b = F.col("bucket")
    n_points = F.max(b) - F.min(b) + 1
    return per_bucket.agg(
        n_points.alias("n_points"),
        (F.sum(count_col) / n_points / F.lit(float(bucket_seconds))).alias("mean_rate"),
        (F.max(count_col) / F.lit(float(bucket_seconds))).alias("max_rate"))


def day_start(ts: str | Column) -> Column:
    """Start of the UTC day as TIMESTAMP_NTZ (day buckets share the type of window starts)."""
    return F.to_date(F.col(ts) if isinstance(ts, str) else ts).cast("timestamp_ntz")


def daily_counts(df: DataFrame, ts: str, counts: dict[str, Column], keys: list[str] | None = None) -> DataFrame:
    return df.groupBy(*(keys or []), day_start(ts).alias("day")).agg(
        *[F.count_if(cond).alias(name) for name, cond in counts.items()])


def running_totals(per_day: DataFrame, value_cols: dict[str, str], keys: list[str] | None = None,
                   order: str = "day") -> DataFrame:
    """RP4: cumulative totals along ``order`` (one row per day and series, never raw rows)."""
    w = Window.partitionBy(*(keys or [])).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_day.withColumns({total: F.sum(v).over(w).cast("long") for v, total in value_cols.items()})


def last_not_null(df: DataFrame, keys: list[str], ts: str, value: str, tie_break: str | None = None) -> DataFrame:
    """RP4 reducer lastNotNull: latest non-null value per series (hash aggregate, no sort)."""
    order = F.struct(F.col(ts), F.col(tie_break)) if tie_break else F.col(ts)
    nn = df.where(F.col(value).isNotNull())
    return nn.groupBy(*keys).agg(F.max(ts).alias(f"last_{ts}"), F.max_by(F.col(value), order).alias(f"last_{value}"))


def counter_increase(counter_series: DataFrame, keys: list[str], order: str, counter: str,
                     interval_seconds: float) -> DataFrame:
    """RP5: increase of a monotone counter that restarts at 0; a drop means a reset, so the
    increase is the new value. The first sample's increase is its value (counting from 0)."""
    w = Window.partitionBy(*keys).orderBy(order)
    prev = F.lag(counter).over(w)
    inc = F.when(prev.isNull() | (F.col(counter) < prev), F.col(counter)).otherwise(F.col(counter) - prev)
    return (counter_series.withColumn("increase", inc.cast("long"))
            .withColumn("rate", F.col("increase") / F.lit(float(interval_seconds))))


def gauge_from_deltas(deltas: DataFrame, keys: list[str], order: str, delta: str = "delta") -> DataFrame:
    """RP6: a gauge moved by +n / -n events = running sum of deltas per series, after summing
    the deltas per (series, time)."""
    per = deltas.groupBy(*keys, order).agg(F.sum(delta).cast("long").alias(delta))
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per.withColumn("gauge", F.sum(delta).over(w).cast("long"))


def approval_rate_series(per_bucket: DataFrame, n: str = "n", n_fraud: str = "n_fraud") -> DataFrame:
    """RP8: approval rate in percent per bucket; null for an empty bucket."""
    return per_bucket.withColumn("approval_pct", F.lit(100.0) * approval_rate(n, n_fraud))


def threshold_bands(df: DataFrame, value: str, warn: float | None = None, crit: float | None = None) -> DataFrame:
    """RP9: green / yellow / red banding."""
    kwargs = {k: v for k, v in (("warn", warn), ("crit", crit)) if v is not None}
    return df.withColumn("band", threshold_band(value, **kwargs))


def trailing_range(df: DataFrame, ts: str, interval: str) -> DataFrame:
    """RP10: rows newer than ``max(ts) - interval``; the bound is a scalar subquery (one
    aggregate), so the filter runs where the rows are."""
    latest = df.select(F.max(ts)).scalar()
    return df.where(F.col(ts) > latest - F.expr(f"INTERVAL {interval}"))
