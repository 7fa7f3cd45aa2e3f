"""The scoring service (ST1-ST5, FE7, IO6, IO7, PR16) as ONE streaming query.

Each micro-batch is parsed once, split into valid and quarantined rows, scored once and
persisted; the batch then fans out to the scored-message sink, the quarantine table and one KPI
row. Every output is written under ``batch_id=<id>`` with overwrite, so a batch replayed after a
failure replaces its own output instead of adding to it (exactly-once effect over at-least-once
delivery). A topic gets a replayed batch twice, under the same message keys (``topic.py``). Input rows = scored rows + quarantined rows for every batch.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.columns import approval_rate
from ..operators.prepare import CORRUPT, parse_json, quarantine_reason
from ..schema import SINK_TRIGGER
from ..sources.publish import to_json_messages
from .topic import append_messages, keyed_messages


@dataclass
class ScoringOutputs:
    scored: str                  # JSON messages, text, partitioned by batch_id
    quarantine: str              # rows set aside with a reason, parquet, by batch_id
    kpis: str                    # one KPI row per batch, parquet, by batch_id
    kafka: dict | None = None    # optional Kafka sink options for the scored messages
    topic: str | None = None     # optional append-only message table, standing in for a topic


def _write_batch(df: DataFrame, root: str, batch_id: int, fmt: str) -> None:
    w = df.write.mode("overwrite")
    path = f"{root}/batch_id={batch_id}"
    (w.text(path) if fmt == "text" else w.parquet(path))


def categories_from_model(model) -> dict[str, list[str]]:
    """Input column -> fitted labels of every StringIndexer in a PipelineModel (the model already
    holds them on the driver; their size is the category cardinality, not the data size)."""
    from pyspark.ml.feature import StringIndexerModel
    known = {}
    for stage in getattr(model, "stages", []):
        if isinstance(stage, StringIndexerModel):
            cols = stage.getInputCols() if stage.isSet("inputCols") else [stage.getInputCol()]
            for c, labels in zip(cols, stage.labelsArray):
                known[c] = list(labels)
    return known


def with_category_reason(df: DataFrame, reason: F.Column, known: dict[str, list[str]] | None) -> DataFrame:
    """``df`` with ``reason``, extended by ``unknown_<col>`` where a category is null or was unseen in the
    fit: the indexer would skip such a row, so it is set aside instead.

    The lookup is the indexer itself, told to keep invalid values: it gives them the index after the last label. The
    labels are a map inside its transformation, so the plan does not grow with their number.
    """
    if not known:
        return df.withColumn("reason", reason)
    from pyspark.ml.feature import StringIndexerModel
    columns = sorted(known)
    probes = [f"__{c}_index" for c in columns]
    indexer = StringIndexerModel.from_arrays_of_labels([list(known[c]) for c in columns], inputCols=columns, outputCols=probes,
                                                       handleInvalid="keep")
    out = indexer.transform(df)
    for c, probe in zip(columns, probes):
        reason = F.when(reason.isNotNull(), reason).when(F.col(probe) >= len(known[c]), F.lit(f"unknown_{c}"))
    return out.withColumn("reason", reason).drop(*probes)


def make_batch_processor(schema: str, required: list[str], scorer: Callable[[DataFrame], DataFrame],
                         outputs: ScoringOutputs, query_name: str, fraud_col: str = "predicted_fraud",
                         high_risk_col: str = "is_high_risk", drop_cols: tuple[str, ...] = (),
                         known_categories: dict[str, list[str]] | None = None):
    """The ``foreachBatch`` body: parse -> quarantine -> score -> fan out -> KPI row.

    The KPI counts are ``Observation`` metrics collected while the scored messages are written,
    so the batch is scored and scanned once; only the parsed batch (read by both the scored and
    the quarantine branch) is persisted.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        started = time.time()
        spark = batch.sparkSession
        parsed = parse_json(batch, "json", schema)
        parsed = with_category_reason(parsed, quarantine_reason(parsed, "json", required), known_categories)
        parsed = parsed.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            good = parsed.where(F.col("reason").isNull()).drop("reason", CORRUPT, "json")
            bad = parsed.where(F.col("reason").isNotNull()).select("json", "reason")
            scored = scorer(good).drop(*drop_cols)
            to_topic = bool(outputs.kafka or outputs.topic)
            if to_topic:
                scored = scored.persist(StorageLevel.MEMORY_AND_DISK)
            kpi_obs = Observation(f"{query_name}_kpi_{batch_id}_{int(started * 1e6)}")
            observed = scored.observe(kpi_obs, F.count(F.lit(1)).alias("n"),
                                      F.count_if(F.col(fraud_col)).alias("n_fraud"),
                                      F.count_if(F.col(high_risk_col)).alias("n_high_risk"))
            try:
                _write_batch(to_json_messages(observed), outputs.scored, batch_id, "text")
                messages = keyed_messages(to_json_messages(scored), query_name, batch_id)
                if outputs.kafka:
                    messages.write.format("kafka").options(**outputs.kafka).save()
                if outputs.topic:
                    append_messages(messages, outputs.topic)
            finally:
                if to_topic:
                    scored.unpersist()
            bad_obs = Observation(f"{query_name}_bad_{batch_id}_{int(started * 1e6)}")
            _write_batch(bad.observe(bad_obs, F.count(F.lit(1)).alias("n")), outputs.quarantine, batch_id,
                         "parquet")
            m, n_bad = kpi_obs.get, bad_obs.get["n"]
            n, n_fraud = int(m["n"]), int(m["n_fraud"])
            kpi = spark.createDataFrame(
                [(query_name, n, n_fraud, int(m["n_high_risk"]), int(n_bad),
                  (n - n_fraud) / n if n else None, time.time() - started,
                  datetime.fromtimestamp(started, UTC), datetime.now(UTC))],
                KPI_SCHEMA)
            _write_batch(kpi.coalesce(1), outputs.kpis, batch_id, "parquet")
        finally:
            parsed.unpersist()

    return process


KPI_SCHEMA = ("query STRING, n BIGINT, n_fraud BIGINT, n_high_risk BIGINT, n_quarantined BIGINT, "
              "approval_rate DOUBLE, duration_seconds DOUBLE, batch_start TIMESTAMP, batch_end TIMESTAMP")


def start_scoring(messages: DataFrame, schema: str, required: list[str], scorer: Callable[[DataFrame], DataFrame],
                  outputs: ScoringOutputs, checkpoint: str, query_name: str = "scoring",
                  trigger: dict | None = None, drop_cols: tuple[str, ...] = (),
                  known_categories: dict[str, list[str]] | None = None) -> StreamingQuery:
    """Start the named scoring query with its own checkpoint (offsets survive restarts).

    ``trigger`` defaults to the reference's 10-second processing-time trigger; tests and
    bounded back-fills pass ``{"availableNow": True}``.
    """
    fn = make_batch_processor(schema, required, scorer, outputs, query_name, drop_cols=drop_cols,
                              known_categories=known_categories)
    writer = (messages.writeStream.queryName(query_name).option("checkpointLocation", checkpoint)
              .foreachBatch(fn))
    writer = writer.trigger(**(trigger or {"processingTime": SINK_TRIGGER}))
    return writer.start()


def run_to_completion(query: StreamingQuery, timeout_s: float | None = None) -> None:
    """Wait for an ``availableNow`` query, and stop it whatever happens (ST5)."""
    try:
        query.awaitTermination(timeout_s) if timeout_s else query.awaitTermination()
    finally:
        if query.isActive:
            query.stop()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def read_kpis(spark: SparkSession, path: str) -> DataFrame:
    """The KPI table: one row per (query, batch_id)."""
    return spark.read.parquet(path)


def kpi_totals(kpis: DataFrame) -> DataFrame:
    """Counters as the dashboards read them: totals over all batches, approval over the total."""
    t = kpis.agg(F.sum("n").cast("long").alias("n"), F.sum("n_fraud").cast("long").alias("n_fraud"),
                 F.sum("n_high_risk").cast("long").alias("n_high_risk"),
                 F.sum("n_quarantined").cast("long").alias("n_quarantined"),
                 F.count(F.lit(1)).alias("n_batches"))
    return t.withColumn("approval_rate", approval_rate("n", "n_fraud"))


def kpi_gauges(kpis: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Gauges as the dashboard shows them (RP7, RP4 lastNotNull): the size of the latest batch,
    the latest non-null approval rate and the slowest batch, from the KPI table by batch id,
    overall or per ``keys`` (the query)."""
    return kpis.groupBy(*(keys or [])).agg(
        F.max("batch_id").alias("last_batch_id"),
        F.max_by("n", "batch_id").alias("batch_size"),
        F.max_by("approval_rate", F.when(F.col("approval_rate").isNotNull(), F.col("batch_id")))
         .alias("approval_rate"),
        F.max("duration_seconds").alias("max_duration_seconds"))


def batch_duration_histogram(kpis: DataFrame) -> DataFrame:
    """AG6 on its own subject: the cumulative histogram of batch processing seconds over the
    reference's bucket edges (0.1 ... 60, +Inf), with sum and count, from the KPI table."""
    from ..operators.aggregates import histogram_le
    return histogram_le(kpis, "duration_seconds").drop("bucket")
