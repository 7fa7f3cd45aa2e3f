"""Registered streaming queries. Each runs a bounded stream (``availableNow``) to completion over
the whole input, then returns the materialized sink as a DataFrame for checking."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import round6
from ..schema import DRIVER_TABLES
from ..session import scratch_path
from ..sources.files import folder_bytes
from ..sources.publish import JSON_OPTIONS, publish_json
from ..sources.tables import read_table
from ..streaming import rates
from ..streaming.scoring import (ScoringOutputs, categories_from_model, kpi_totals, make_batch_processor, read_kpis, run_to_completion,
                                 start_scoring)
from ..streaming.sources import message_stream, table_stream
from ..streaming.topic import distinct_stream, topic_stream
from ..operators.scoring import with_score_flags
from .ml import _scoring_model
from .registry import register
from .views import ev_from, ml_events, scored_from

EVENT_SCHEMA = DRIVER_TABLES["events"]
REQUIRED = ["event_id", "ts", "props", "value"]
RECORDS_PER_FILE = 10000
BYTES_PER_TRIGGER = 128 << 20
AVAILABLE_NOW = {"availableNow": True}


def _publish(spark: SparkSession, rows: DataFrame, unseen: str | None = None) -> str:
    """IO8: every row as one JSON message (distributed text write), some of them damaged on their way: ids
    divisible by 11 lose their last brace, by 17 their value, and by 13 have a category that no fit has seen."""
    path = scratch_path(spark, "messages")
    damaged = rows.withColumn("value", F.when(F.col("event_id") % 17 != 0, F.col("value")))
    if unseen:
        damaged = damaged.withColumn(unseen, F.when(F.col("event_id") % 13 == 0, F.lit("never seen")).otherwise(F.col(unseen)))
    message = F.to_json(F.struct(*damaged.columns), JSON_OPTIONS)
    cut = F.when(F.col("event_id") % 11 == 0, F.substring(message, F.lit(1), F.length(message) - 1)).otherwise(message)
    damaged.select(cut.alias("value")).write.option("maxRecordsPerFile", RECORDS_PER_FILE).mode("overwrite").text(path)
    return path


def _messages(spark: SparkSession, path: str) -> DataFrame:
    """The published messages as a stream, in two micro-batches or as many as their bytes need: a batch has fixed costs, so their
    number must not grow with the files that the writer left."""
    half = -(-folder_bytes(spark, path) // 2)
    return message_stream(spark, "files", path=path, max_bytes_per_trigger=max(1, min(BYTES_PER_TRIGGER, half)))


def _score_stream(spark: SparkSession, sf_dir: str) -> ScoringOutputs:
    """One run of the scoring service over the whole published input; its sinks (scored
    messages, quarantine, KPI rows) are read by the queries below, like any consumer would."""
    src = _publish(spark, read_table(spark, sf_dir, "events"))
    outputs = ScoringOutputs(scored=scratch_path(spark, "scored"), quarantine=scratch_path(spark, "quarantine"),
                             kpis=scratch_path(spark, "kpis"))
    stream = _messages(spark, src)
    q = start_scoring(stream, EVENT_SCHEMA, REQUIRED, lambda df: scored_from(ev_from(df)), outputs,
                      checkpoint=scratch_path(spark, "ckpt-scoring"), query_name="scoring",
                      trigger=AVAILABLE_NOW, drop_cols=("rawPrediction", "probability"))
    run_to_completion(q)
    return outputs


@register("stream_ingest")
def q_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IO5 + ST2 + ST4: file stream of events into a parquet sink with its own checkpoint."""
    out, ckpt = scratch_path(spark, "ingest"), scratch_path(spark, "ckpt-ingest")
    q = (table_stream(spark, sf_dir, "events").writeStream.queryName("ingest").format("parquet")
         .option("checkpointLocation", ckpt).trigger(**AVAILABLE_NOW).start(out))
    run_to_completion(q)
    return spark.read.schema(EVENT_SCHEMA).parquet(out)


@register("stream_score_sink")
def q_stream_score_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST1 + FE7 + IO6 + PR7: messages -> parse -> score -> flags -> JSON sink; read back."""
    outputs = _score_stream(spark, sf_dir)
    return _scored_fields(spark.read.text(outputs.scored))


def _scored_fields(messages: DataFrame) -> DataFrame:
    j = F.col("value")
    return messages.select(
        F.get_json_object(j, "$.event_id").cast("long").alias("event_id"),
        F.get_json_object(j, "$.prediction").cast("double").alias("prediction"),
        round6(F.get_json_object(j, "$.fraud_probability").cast("double")).alias("fraud_probability"),
        F.get_json_object(j, "$.predicted_fraud").cast("boolean").alias("predicted_fraud"),
        F.get_json_object(j, "$.is_high_risk").cast("boolean").alias("is_high_risk"))


def _replayed_topic(spark: SparkSession, sf_dir: str) -> str:
    """A topic that the scoring service wrote in two runs: the first one ends after it has written its first batch and
    before the batch is committed, the second one replays that batch and goes on."""
    src, ckpt, topic = _publish(spark, read_table(spark, sf_dir, "events")), scratch_path(spark, "ckpt-topic"), scratch_path(spark, "topic")
    outputs = ScoringOutputs(scored=scratch_path(spark, "scored"), quarantine=scratch_path(spark, "quarantine"),
                             kpis=scratch_path(spark, "kpis"), topic=topic)
    process = make_batch_processor(EVENT_SCHEMA, REQUIRED, lambda df: scored_from(ev_from(df)), outputs, "scoring",
                                   drop_cols=("rawPrediction", "probability"))
    stop = "stopped before the batch was committed"

    def process_and_stop(batch: DataFrame, batch_id: int) -> None:
        process(batch, batch_id)
        raise RuntimeError(stop)

    for body in (process_and_stop, process):
        stream = _messages(spark, src)
        q = (stream.writeStream.queryName("topic").option("checkpointLocation", ckpt).trigger(**AVAILABLE_NOW).foreachBatch(body).start())
        try:
            run_to_completion(q)
        except StreamingQueryException as e:
            if body is process or stop not in str(e):
                raise
    return topic


@register("stream_topic_once")
def q_stream_topic_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IO6: the scored messages of a topic that holds a replayed batch twice, read as a stream that keeps one per key."""
    topic, out = _replayed_topic(spark, sf_dir), scratch_path(spark, "once")
    q = (distinct_stream(topic_stream(spark, topic)).writeStream.queryName("once").format("parquet")
         .option("checkpointLocation", scratch_path(spark, "ckpt-once")).trigger(**AVAILABLE_NOW).start(out))
    run_to_completion(q)
    return _scored_fields(spark.read.parquet(out))


@register("stream_batch_kpis")
def q_stream_batch_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST3 + IO7: per-batch KPI rows (idempotent by batch id), summed over batches."""
    outputs = _score_stream(spark, sf_dir)
    t = kpi_totals(read_kpis(spark, outputs.kpis))
    return t.select("n", "n_fraud", "n_high_risk", "n_quarantined", round6("approval_rate").alias("approval_rate"))


@register("stream_model_score")
def q_stream_model_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FE7 + ST1 + PR16: messages -> quarantine -> saved encoders and model in every micro-batch, against the batch
    scoring by the same artifact. Per event: scored or the reason it was set aside, and whether prediction and
    probability are those of the batch."""
    model = _scoring_model(spark, sf_dir)
    rows = ml_events(spark, sf_dir)
    src = _publish(spark, rows.drop("ts", "is_fraud"), unseen="user_bucket")
    outputs = ScoringOutputs(scored=scratch_path(spark, "scored"), quarantine=scratch_path(spark, "quarantine"), kpis=scratch_path(spark, "kpis"))
    schema = ", ".join(f"`{n}` {t}" for n, t in rows.drop("ts", "is_fraud").dtypes)
    score = lambda df: with_score_flags(model.transform(df))
    keep = ["event_id", "prediction", "fraud_probability", "predicted_fraud", "is_high_risk"]
    q = start_scoring(_messages(spark, src), schema,
                      ["event_id", "value", "k", "entity_id", "device_info"], lambda df: score(df).select(*keep), outputs,
                      checkpoint=scratch_path(spark, "ckpt-model"), query_name="model_scoring", trigger=AVAILABLE_NOW,
                      known_categories=categories_from_model(model))
    run_to_completion(q)
    fields = "event_id BIGINT, prediction DOUBLE, fraud_probability DOUBLE, predicted_fraud BOOLEAN, is_high_risk BOOLEAN"
    streamed = spark.read.text(outputs.scored).select(F.from_json("value", fields).alias("m")).select("m.*")
    batch = score(rows).select(F.col("event_id"), *[F.col(c).alias(f"batch_{c}") for c in keep[1:]])
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"batch_{c}")) for c in keep[1:]])
    good = streamed.join(batch, "event_id").select("event_id", F.lit("scored").alias("outcome"), same.alias("as_in_batch"))
    bad = spark.read.parquet(outputs.quarantine).select(
        F.regexp_extract("json", r'"event_id":(\d+)', 1).cast("long").alias("event_id"), F.col("reason").alias("outcome"),
        F.lit(None).cast("boolean").alias("as_in_batch"))
    return good.union(bad)


STREAM_WINDOW = "1 hour"


@register("stream_rate")
def q_stream_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST6: hourly event counts on the stream, of every event whatever its batch."""
    out, ckpt = scratch_path(spark, "rates"), scratch_path(spark, "ckpt-rates")
    events = table_stream(spark, sf_dir, "events", max_files_per_trigger=1)
    run_to_completion(rates.start_window_counts(events, "ts", STREAM_WINDOW, out, ckpt, AVAILABLE_NOW))
    r = rates.read_window_counts(spark, out)
    return r.select("window_start", "window_end", "n", round6(F.col("n") / 3600.0).alias("rate"))


@register("stream_rate_compacted")
def q_stream_rate_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST6 over many batches, compacted between them, with a second run that goes on from the first one's checkpoint."""
    out, ckpt, src = (scratch_path(spark, n) for n in ("rates", "ckpt-rates", "events"))
    events = read_table(spark, sf_dir, "events")
    for part in range(2):  # new files arrive after the first run has ended
        events.filter(F.pmod(F.col("event_id"), F.lit(2)) == part).repartition(5).write.mode("append").parquet(src)
        stream = spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
        run_to_completion(rates.start_window_counts(stream, "ts", STREAM_WINDOW, out, ckpt, AVAILABLE_NOW, compact_every=2))
    r = rates.read_window_counts(spark, out)
    return r.select("window_start", "window_end", "n", round6(F.col("n") / 3600.0).alias("rate"))


@register("publish_json")
def q_publish_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IO8: the events table published as JSON messages (one distributed write), read back."""
    path = scratch_path(spark, "published")
    publish_json(read_table(spark, sf_dir, "events"), "text", path)
    parsed = spark.read.text(path).select(F.from_json("value", EVENT_SCHEMA, JSON_OPTIONS).alias("m"))
    return parsed.select("m.*")
