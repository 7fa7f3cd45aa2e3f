"""Series of sampled counters and of batch rows as the dashboards read them (RP1, RP2, RP5-RP7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import ordered_prefix_sums


def _micros(ts: str) -> Column:
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(ts).cast("timestamp_ntz"))


def counter_rate(samples: DataFrame, keys: list[str], ts: str, counter: str, range_seconds: int) -> DataFrame:
    """RP1, RP2, RP5: increase and rate per second of a sampled counter over the trailing range, at every sample.

    A sample's range is (t - range, t]. A value below the one before means that the counter restarted at
    0, so the new value is the increase. ``increase`` adds the increases between the samples in the range
    (``n_samples``); with a single sample it is null, as nothing is known. ``rate`` is increase / range,
    without extrapolation to the range's edges. Samples of one time are taken by rising value; samples without a time
    or value are left out.

    Only samples of one range length meet: every sample is read in its own stretch of that length and
    as the past of the next one, so a long or hot series spreads over all its stretches.
    """
    span = range_seconds * 1_000_000
    rows = (samples.select(*keys, ts, counter, _micros(ts).alias("__t")).filter(F.col("__t").isNotNull() & F.col(counter).isNotNull())
            .withColumn("__own", F.floor(F.col("__t") / F.lit(span)))
            .withColumn("__stretch", F.explode(F.array(F.col("__own"), F.col("__own") + 1))))
    of = Window.partitionBy(*keys, "__stretch")
    line = of.orderBy("__t", counter)
    before = F.lag(counter).over(line)
    step = F.when(before.isNull(), 0).when(F.col(counter) < before, F.col(counter)).otherwise(F.col(counter) - before)
    rows = rows.withColumn("__step", step)
    rows = rows.withColumn("__sum", F.sum("__step").over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    within = of.orderBy("__t").rangeBetween(-(span - 1), Window.currentRow)
    rows = rows.select(*keys, ts, counter, "__own", "__stretch", "__sum", F.count(F.lit(1)).over(within).alias("n_samples"),
                       F.min("__sum").over(within).alias("__first"), F.max("__sum").over(within).alias("__last"))
    increase = F.when(F.col("n_samples") > 1, F.col("__last") - F.col("__first"))
    return (rows.filter("__stretch = __own").select(*keys, ts, counter, "n_samples", increase.alias("increase"))
            .withColumn("rate", F.col("increase") / F.lit(float(range_seconds))))


def in_flight(batches: DataFrame, start: str = "batch_start", end: str = "batch_end", n: str = "n") -> DataFrame:
    """RP6: records in flight over all batches and queries: +n when a batch starts, -n when it ends.

    One row per instant: ``instant``, ``delta`` and ``in_flight`` after it. A batch that has not ended (null) stays in
    flight; one without a start is left out; what starts and ends at one instant cancels out there.
    The running sum is a global one over range-sorted instants, no single-task window.
    """
    ends = F.array(F.struct(F.col(start).alias("instant"), F.col(n).alias("delta")), F.struct(F.col(end).alias("instant"), (-F.col(n)).alias("delta")))
    deltas = batches.filter(F.col(start).isNotNull()).select(F.explode(ends).alias("e")).select("e.*").filter("instant is not null")
    per = deltas.groupBy("instant").agg(F.sum("delta").cast("long").alias("delta"))
    return ordered_prefix_sums(per, [F.col("instant")], ["delta"], "cum_").select("instant", "delta", F.col("cum_delta").cast("long").alias("in_flight"))
