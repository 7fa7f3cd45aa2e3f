"""ST6: event-time rates on the live stream, complete whatever the order of arrival.

Every micro-batch adds its counts per event-time window to a table, keyed by batch id; reading the
table sums them up. No event is late: a window's count grows for as long as events for it arrive, no
state is held between batches, and a batch that is run again replaces its own counts.

Compaction keeps the table small: the counts of all batches up to one are merged into a new version of a base table, whose
manifest, written last under a name of its own, says up to which batch it goes. Readers take the
latest manifest and the batches after it, so a crash at any point loses and doubles nothing.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.files import delete, is_materialized, names_in, read_text, rename, write_text


def window_counts(df: DataFrame, ts: str, window: str, slide: str | None = None,
                  counts: dict[str, Column] | None = None) -> DataFrame:
    """window_start, window_end, n and one conditional count per entry of ``counts``."""
    w = F.window(F.col(ts).cast("timestamp"), window, slide) if slide else F.window(F.col(ts).cast("timestamp"), window)
    aggs = [F.count(F.lit(1)).alias("n")] + [F.count_if(c).alias(name) for name, c in (counts or {}).items()]
    out = df.groupBy(w.alias("w")).agg(*aggs)
    return out.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                      F.col("w.end").cast("timestamp_ntz").alias("window_end"), *[a for a in out.columns if a != "w"])


def start_window_counts(stream: DataFrame, ts: str, window: str, out: str, checkpoint: str, trigger: dict,
                        slide: str | None = None, counts: dict[str, Column] | None = None,
                        name: str = "rates", compact_every: int | None = None) -> StreamingQuery:
    """Start the query that writes every batch's window counts under ``out/batch_id=<id>``. Bound
    the micro-batches at the source (``maxFilesPerTrigger``, ``maxOffsetsPerTrigger``). With
    ``compact_every`` the counts so far are compacted before every so many batches."""

    def add(batch: DataFrame, batch_id: int) -> None:
        # the batches before this one are committed: only this one may run again
        if compact_every and batch_id and batch_id % compact_every == 0:
            compact(batch.sparkSession, out, batch_id - 1)
        window_counts(batch, ts, window, slide, counts).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return (stream.writeStream.queryName(name).foreachBatch(add)
            .option("checkpointLocation", checkpoint).trigger(**trigger).start())


def _base(spark: SparkSession, out: str) -> tuple[int, int]:
    """Version of the latest whole base table and the batch up to which it goes; (0, -1) without one."""
    versions = [int(n[:-len(".json")]) for n in names_in(spark, f"{out}/_base") if n.endswith(".json")]
    if not versions:
        return 0, -1
    return max(versions), json.loads(read_text(spark, f"{out}/_base/{max(versions)}.json"))["up_to"]


def _batches(spark: SparkSession, out: str) -> list[int]:
    """Batches that are written whole."""
    ids = [int(n.split("=")[1]) for n in names_in(spark, out) if n.startswith("batch_id=")]
    return sorted(i for i in ids if is_materialized(spark, f"{out}/batch_id={i}"))


def _parts(spark: SparkSession, out: str, after: int, up_to: int | None = None) -> list[str]:
    version, _ = _base(spark, out)
    paths = [f"{out}/batch_id={i}" for i in _batches(spark, out) if i > after and (up_to is None or i <= up_to)]
    return ([f"{out}/_base/{version}"] if version else []) + paths


def _summed(spark: SparkSession, paths: list[str]) -> DataFrame:
    parts = spark.read.parquet(*paths)
    names = [c for c in parts.columns if c not in ("window_start", "window_end")]
    return parts.groupBy("window_start", "window_end").agg(*[F.sum(c).alias(c) for c in names])


def compact(spark: SparkSession, out: str, up_to: int) -> int:
    """Merge the batches up to ``up_to`` (committed ones) into the next version of the base table, and return the
    version; then drop what the version before has covered: its readers may still be at the
    batches that this one covers."""
    version, done = _base(spark, out)
    if up_to <= done or not any(done < i <= up_to for i in _batches(spark, out)):
        return version
    new = version + 1
    _summed(spark, _parts(spark, out, done, up_to)).write.mode("overwrite").parquet(f"{out}/_base/{new}")
    staged = f"{out}/_base/{new}.json.{uuid.uuid4().hex[:12]}"
    write_text(spark, staged, json.dumps({"up_to": up_to}))
    rename(spark, staged, f"{out}/_base/{new}.json")
    for i in _batches(spark, out):
        if i <= done:
            delete(spark, f"{out}/batch_id={i}")
    if version > 1:
        delete(spark, f"{out}/_base/{version - 1}.json")
        delete(spark, f"{out}/_base/{version - 1}")
    return new


def read_window_counts(spark: SparkSession, out: str) -> DataFrame:
    """The counts so far: one row per window, summed over the base table and the batches after it."""
    return _summed(spark, _parts(spark, out, _base(spark, out)[1]))
