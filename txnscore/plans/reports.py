"""Registered dashboard queries (RP1-RP10) over scored and raw events, orders and lineitems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import round6
from ..operators import reporting as rp
from ..operators import series
from ..sources.tables import read_table
from ..streaming.scoring import batch_duration_histogram, kpi_gauges
from .registry import register
from .views import ev, scored



def _counts() -> dict:
    return {"n": F.lit(True), "n_fraud": F.col("predicted_fraud")}


@register("rate_5m")
def q_rate_5m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RP1: processed and fraud rate over 5-minute windows sliding by 1 minute."""
    w = rp.sliding_window_counts(scored(spark, sf_dir), "ts", 300, 60, _counts())
    w = rp.with_rates(w, 300, {"n": "rate", "n_fraud": "fraud_rate"})
    return w.withColumns({"rate": round6("rate"), "fraud_rate": round6("fraud_rate")})


@register("rate_1m")
def q_rate_1m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RP2: throughput over 1-minute tumbling windows."""
    w = rp.tumbling_window_counts(scored(spark, sf_dir), "ts", 60, _counts())
    w = rp.with_rates(w, 60, {"n": "rate", "n_fraud": "fraud_rate"})
    return w.withColumns({"rate": round6("rate"), "fraud_rate": round6("fraud_rate")})


@register("rate_summary")
def q_rate_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RP3: mean and max of the 1-minute rate, empty minutes included."""
    per = rp.bucket_counts(scored(spark, sf_dir), "ts", 60, {"n": F.lit(True)})
    s = rp.rate_summary(per, "n", 60)
    return s.select("n_points", round6("mean_rate").alias("mean_rate"), round6("max_rate").alias("max_rate"))


@register("running_totals")
def q_running_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RP4: cumulative processed and fraud totals by day."""
    per_day = rp.daily_counts(scored(spark, sf_dir), "ts", _counts())
    return rp.running_totals(per_day, {"n": "total_processed", "n_fraud": "total_fraud"})


@register("last_not_null")
def q_last_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RP4 reducer: latest non-null value per event type (ties by event id)."""
    return rp.last_not_null(ev(spark, sf_dir), ["event_type"], "ts", "value", tie_break="event_id")


@register("counter_increase")
def q_counter_increase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RP5: daily cumulative counters per event type that restart every 7 days -> increases."""
    from pyspark.sql import Window
    per_day = rp.daily_counts(ev(spark, sf_dir), "ts", {"n": F.lit(True)}, ["event_type"])
    period = F.floor(F.datediff(F.to_date("day"), F.lit("1970-01-01").cast("date")) / 7)
    w = (Window.partitionBy("event_type", period).orderBy("day")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    counters = per_day.withColumn("counter", F.sum("n").over(w).cast("long"))
    out = rp.counter_increase(counters, ["event_type"], "day", "counter", 86400)
    return out.select("event_type", "day", "counter", "increase", round6("rate").alias("rate"))


@register("gauge_from_deltas")
def q_gauge_from_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RP6: open orders per priority: +1 on the order date, -1 on the last ship date."""
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate", "o_orderpriority"])
    last_ship = (read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_shipdate"])
                 .groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last_ship")))
    # one pass over orders: each order emits its +1 and, if it has lines, its -1
    j = o.join(last_ship, o.o_orderkey == last_ship.l_orderkey, "left")
    start = F.struct(rp.day_start("o_orderdate").alias("day"), F.lit(1).alias("delta"))
    end = F.struct(rp.day_start("last_ship").alias("day"), F.lit(-1).alias("delta"))
    events = F.when(F.col("last_ship").isNull(), F.array(start)).otherwise(F.array(start, end))
    deltas = j.select(F.col("o_orderpriority").alias("priority"), F.explode(events).alias("d")).select(
        "priority", "d.day", "d.delta")
    return rp.gauge_from_deltas(deltas, ["priority"], "day")


@register("approval_rate_series")
def q_approval_rate_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RP8: daily approval rate, percent."""
    per_day = rp.daily_counts(scored(spark, sf_dir), "ts", _counts())
    return rp.approval_rate_series(per_day).withColumn("approval_pct", round6("approval_pct"))


@register("threshold_bands")
def q_threshold_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RP9: daily event counts banded at 100 / 500."""
    per_day = rp.daily_counts(ev(spark, sf_dir), "ts", {"n": F.lit(True)})
    return rp.threshold_bands(per_day, "n")


@register("trailing_range")
def q_trailing_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RP10: the last day of events relative to the newest one."""
    e = ev(spark, sf_dir).select("event_id", "ts", "event_type", "value")
    return rp.trailing_range(e, "ts", "1 DAY")


# --- sampled counters and batch rows -------------------------------------------------------------

def counter_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in for scraped counters: one series per event type, sampled at the minutes that have events, of a process
    that restarts every hour."""
    e = read_table(spark, sf_dir, "events", ["ts", "event_type"])
    per = e.groupBy("event_type", F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("ts")).agg(F.count(F.lit(1)).alias("n"))
    since = Window.partitionBy("event_type", F.date_trunc("hour", "ts")).orderBy("ts")
    return per.select("event_type", "ts", F.sum("n").over(since).cast("long").alias("counter"))


def batch_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in for the service's KPI table: one query per event type, one batch per hour, which lasts from
    its first to its last event."""
    s = scored(spark, sf_dir)
    hour = F.floor(F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts")) / 3600)
    rows = s.groupBy(F.col("event_type").alias("query"), hour.alias("batch_id")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("predicted_fraud").alias("n_fraud"), F.min("ts").alias("batch_start"), F.max("ts").alias("batch_end"))
    seconds = F.timestamp_diff("MICROSECOND", F.col("batch_start"), F.col("batch_end")) / 60e6
    return rows.select("*", ((F.col("n") - F.col("n_fraud")) / F.col("n")).alias("approval_rate"), seconds.alias("duration_seconds"))


@register("counter_rate_5m")
def q_counter_rate_5m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RP1 + RP5: 5-minute rate of counters that reset, over irregular samples."""
    r = series.counter_rate(counter_samples(spark, sf_dir), ["event_type"], "ts", "counter", 300)
    return r.select("event_type", "ts", "counter", "n_samples", F.col("increase").cast("double").alias("increase"), round6("rate").alias("rate"))


@register("counter_rate_1m")
def q_counter_rate_1m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RP2: throughput per second over the trailing two scrapes of a minute each, from the counters."""
    r = series.counter_rate(counter_samples(spark, sf_dir), ["event_type"], "ts", "counter", 120)
    return r.select("event_type", "ts", "n_samples", F.col("increase").cast("double").alias("increase"), round6("rate").alias("rate"))


@register("in_flight_records")
def q_in_flight_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RP6: records in flight over overlapping batches of several queries."""
    return series.in_flight(batch_rows(spark, sf_dir))


@register("kpi_gauges")
def q_kpi_gauges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RP7 + RP4: size, approval rate and duration gauges of the latest batches, per query."""
    g = kpi_gauges(batch_rows(spark, sf_dir), ["query"])
    return g.select("query", "last_batch_id", "batch_size", round6("approval_rate").alias("approval_rate"),
                    round6("max_duration_seconds").alias("max_duration_seconds"))


@register("batch_duration_histogram")
def q_batch_duration_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG6: cumulative histogram of the batches' durations."""
    h = batch_duration_histogram(batch_rows(spark, sf_dir))
    return h.withColumn("value_sum", round6("value_sum"))
