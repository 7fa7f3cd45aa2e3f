"""Streaming: batch/stream equality, no row loss, idempotent KPI rows on restart."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from txnscore.plans.streams import EVENT_SCHEMA, REQUIRED
from txnscore.plans.views import ev_from, scored_from
from txnscore.sources.publish import to_json_messages
from txnscore.sources.tables import read_table
from txnscore.streaming.scoring import ScoringOutputs, kpi_totals, read_kpis, run_to_completion, start_scoring
from txnscore.streaming.sources import message_stream


def _messages(spark, root, damaged_every=None):
    events = read_table(spark, SF_SMALL, "events")
    msgs = to_json_messages(events)
    if damaged_every:
        cut = F.expr("substring(value, 1, length(value) - 3)")
        msgs = msgs.withColumn("value", F.when(F.rand(7) < 1.0 / damaged_every, cut).otherwise(F.col("value")))
    path = os.path.join(root, "in")
    msgs.write.option("maxRecordsPerFile", 300).mode("overwrite").text(path)
    return path


def _run(spark, src, root, ckpt):
    outputs = ScoringOutputs(scored=os.path.join(root, "scored"), quarantine=os.path.join(root, "q"),
                             kpis=os.path.join(root, "kpis"))
    q = start_scoring(message_stream(spark, "files", path=src, max_files_per_trigger=1), EVENT_SCHEMA, REQUIRED,
                      lambda df: scored_from(ev_from(df)), outputs, checkpoint=ckpt, query_name="t",
                      trigger={"availableNow": True}, drop_cols=("rawPrediction", "probability"))
    run_to_completion(q)
    return outputs


def test_stream_equals_batch_and_restart_adds_nothing(spark):
    root = tempfile.mkdtemp(prefix="txnscore-test-")
    src = _messages(spark, root, damaged_every=10)
    ckpt = os.path.join(root, "ckpt")
    out = _run(spark, src, root, ckpt)
    kpis = read_kpis(spark, out.kpis)
    n_in = spark.read.text(src).count()
    t = kpi_totals(kpis).first()
    assert kpis.select("batch_id").distinct().count() == kpis.count() >= 2
    assert t.n + t.n_quarantined == n_in and t.n_quarantined > 0          # nothing lost
    scored_stream = spark.read.text(out.scored).select(
        F.get_json_object("value", "$.event_id").cast("long").alias("event_id"),
        F.get_json_object("value", "$.prediction").cast("double").alias("prediction"))
    batch = scored_from(ev_from(read_table(spark, SF_SMALL, "events"))).select("event_id", "prediction")
    assert scored_stream.exceptAll(batch).count() == 0
    before = kpis.count()
    out2 = _run(spark, src, root, ckpt)                                     # restart, same checkpoint
    assert read_kpis(spark, out2.kpis).count() == before


def test_replayed_batch_id_keeps_one_kpi_row(spark):
    from txnscore.streaming.scoring import make_batch_processor
    root = tempfile.mkdtemp(prefix="txnscore-test-")
    outputs = ScoringOutputs(scored=os.path.join(root, "s"), quarantine=os.path.join(root, "q"),
                             kpis=os.path.join(root, "k"))
    fn = make_batch_processor(EVENT_SCHEMA, REQUIRED, lambda df: scored_from(ev_from(df)), outputs, "t",
                              drop_cols=("rawPrediction", "probability"))
    batch = to_json_messages(read_table(spark, SF_SMALL, "events")).withColumnRenamed("value", "json")
    fn(batch, 3)
    fn(batch, 3)
    assert read_kpis(spark, outputs.kpis).count() == 1
    fn(batch.limit(0), 4)                                                   # an empty batch
    from txnscore.streaming.scoring import kpi_gauges
    k = read_kpis(spark, outputs.kpis)
    g = kpi_gauges(k).first()
    first = k.where("batch_id = 3").first()
    assert g.last_batch_id == 4 and g.batch_size == 0
    assert g.approval_rate == first.approval_rate                           # previous value kept
    from txnscore.streaming.scoring import batch_duration_histogram
    h = {r.le: r for r in batch_duration_histogram(k).collect()}
    assert h["+Inf"].cumulative_count == 2 and h["+Inf"].value_count == 2
    assert [h[x].cumulative_count for x in ("0.1", "1.0", "60.0")] == sorted(
        h[x].cumulative_count for x in ("0.1", "1.0", "60.0"))


def test_saved_pipeline_scores_stream_like_batch(spark):
    """Train -> save -> score_stream: same predictions as batch; unseen categories quarantined."""
    from pyspark.ml import PipelineModel
    from txnscore.api import score_stream
    from txnscore.operators import models as ml
    from txnscore.operators.features import feature_pipeline
    from txnscore.plans.views import ml_events
    from pyspark.sql import types as T
    root = tempfile.mkdtemp(prefix="txnscore-test-")
    data = ml_events(spark, SF_SMALL)
    fit_rows = data.where(F.col("user_bucket") != "4")               # bucket 4 is never seen at fit
    model = ml.fit_pipeline(feature_pipeline(["value", "k"], ["user_bucket"], "entity_id", "device_info"),
                            ml.gbt("is_fraud", max_depth=2, max_iter=3), fit_rows)
    model.write().overwrite().save(os.path.join(root, "model"))
    src = os.path.join(root, "in")
    to_json_messages(data).write.option("maxRecordsPerFile", 400).text(src)
    schema = T.StructType([f for f in data.schema.fields])
    outputs = ScoringOutputs(os.path.join(root, "s"), os.path.join(root, "q"), os.path.join(root, "k"))
    q = score_stream(spark, message_stream(spark, "files", path=src, max_files_per_trigger=1),
                     os.path.join(root, "model"), outputs, os.path.join(root, "ckpt"), required=["event_id"],
                     trigger={"availableNow": True}, schema=schema,
                     drop_cols=("rawPrediction", "probability", "features", "entity_id_hashed",
                                "device_infoVector", "device_infoTokens", "entity_id_tokens"))
    run_to_completion(q)
    streamed = spark.read.text(outputs.scored).select(
        F.get_json_object("value", "$.event_id").cast("long").alias("event_id"),
        F.get_json_object("value", "$.prediction").cast("double").alias("prediction"))
    batch = PipelineModel.load(os.path.join(root, "model")).transform(data).select("event_id", "prediction")
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0
    quarantined = spark.read.parquet(outputs.quarantine)
    n_unseen = data.where(F.col("user_bucket") == "4").count()
    assert n_unseen > 0
    assert quarantined.where("reason = 'unknown_user_bucket'").count() == n_unseen
    t = kpi_totals(read_kpis(spark, outputs.kpis)).first()
    assert t.n + t.n_quarantined == data.count()


def test_reference_schema_stream_quarantines_null_model_inputs(spark):
    """score_stream on the 67-field message schema: a message with a null numeric feature is set
    aside (the assembler would otherwise fail the batch); a complete message is scored."""
    import json
    from pyspark.ml.classification import GBTClassifier
    from txnscore.api import feature_pipeline, score_stream
    from txnscore.operators import models as ml
    from txnscore.schema import FEATURE_SCHEMA, TRAINING_SCHEMA
    root = tempfile.mkdtemp(prefix="txnscore-test-")
    base = {f.name: 1.0 for f in FEATURE_SCHEMA.fields}
    base.update(card1=10409, ENTITY_ID="10409_170.0_-206", ProductCD="W", card6="debit",
                DeviceType="mobile", DeviceInfo="SM-G950F Build/NRD90M")
    rows = [dict(base, TransactionAmt=float(i), isFraud=i % 2) for i in range(20)]
    train = spark.createDataFrame([tuple(r[f.name] if f.dataType.simpleString() != "int" else int(r[f.name])
                                         for f in TRAINING_SCHEMA.fields) for r in rows], TRAINING_SCHEMA)
    model = ml.fit_pipeline(feature_pipeline(), GBTClassifier(labelCol="isFraud", maxIter=2, maxDepth=2), train)
    model.write().overwrite().save(os.path.join(root, "m"))
    good = dict(base, TransactionAmt=3.0)
    bad = dict(base, V62=None)
    src = os.path.join(root, "in")
    os.makedirs(src)
    with open(os.path.join(src, "part-0.txt"), "w") as fh:
        fh.write(json.dumps(good) + "\n" + json.dumps(bad) + "\n")
    outputs = ScoringOutputs(os.path.join(root, "s"), os.path.join(root, "q"), os.path.join(root, "k"))
    q = score_stream(spark, message_stream(spark, "files", path=src), os.path.join(root, "m"), outputs,
                     os.path.join(root, "ckpt"), trigger={"availableNow": True},
                     drop_cols=("rawPrediction", "probability", "features", "ENTITY_ID_hashed",
                                "DeviceInfoVector", "DeviceInfoTokens", "ENTITY_ID_tokens"))
    run_to_completion(q)
    assert spark.read.text(outputs.scored).count() == 1
    reasons = [r.reason for r in spark.read.parquet(outputs.quarantine).collect()]
    assert reasons == ["missing_V62"]


def test_failure_after_partial_output_then_restart_is_exactly_once(spark):
    """Run 1 dies inside a batch after its scored messages were written (the Kafka sink is not
    available here); run 2 restarts on the same checkpoint, replays that batch and overwrites its
    output: every input row is scored exactly once and each batch has one KPI row."""
    import pytest
    root = tempfile.mkdtemp(prefix="txnscore-test-")
    src = _messages(spark, root)
    ckpt = os.path.join(root, "ckpt")
    outputs = ScoringOutputs(scored=os.path.join(root, "scored"), quarantine=os.path.join(root, "q"),
                             kpis=os.path.join(root, "kpis"), kafka={"kafka.bootstrap.servers": "none:9",
                                                                      "topic": "t"})
    scorer = lambda df: scored_from(ev_from(df))
    args = dict(trigger={"availableNow": True}, drop_cols=("rawPrediction", "probability"))
    q = start_scoring(message_stream(spark, "files", path=src, max_files_per_trigger=1), EVENT_SCHEMA, REQUIRED,
                      scorer, outputs, checkpoint=ckpt, query_name="f", **args)
    with pytest.raises(Exception):
        run_to_completion(q)
    assert spark.read.text(outputs.scored).count() > 0          # partial output of the failed batch
    outputs.kafka = None
    q = start_scoring(message_stream(spark, "files", path=src, max_files_per_trigger=1), EVENT_SCHEMA, REQUIRED,
                      scorer, outputs, checkpoint=ckpt, query_name="f", **args)
    run_to_completion(q)
    n_in = spark.read.text(src).count()
    ids = spark.read.text(outputs.scored).select(F.get_json_object("value", "$.event_id").alias("id"))
    assert ids.count() == n_in and ids.distinct().count() == n_in
    kpis = read_kpis(spark, outputs.kpis)
    assert kpis.count() == kpis.select("batch_id").distinct().count()
    assert kpi_totals(kpis).first().n == n_in


def test_table_stream_reads_a_directory_table(spark):
    """A table written as a directory of part files streams completely (as at scale)."""
    from txnscore.streaming.sources import table_stream
    root = tempfile.mkdtemp(prefix="txnscore-test-")
    events = read_table(spark, SF_SMALL, "events")
    events.repartition(4).write.parquet(os.path.join(root, "events.parquet"))
    out, ckpt = os.path.join(root, "out"), os.path.join(root, "ckpt")
    q = (table_stream(spark, root, "events", max_files_per_trigger=2).writeStream.format("parquet")
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start(out))
    run_to_completion(q)
    got = spark.read.parquet(out)
    assert got.count() == events.count() and got.exceptAll(events).count() == 0


def test_rates_count_every_event_in_any_batch_order(spark, tmp_path):
    """Eight shuffled part files, one per micro-batch: the counts equal those of the whole table."""
    from pyspark.sql import functions as F
    from txnscore.streaming import rates
    from txnscore.streaming.sources import table_stream
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    folder = str(tmp_path / "sf")
    events.orderBy(F.xxhash64("event_id")).repartition(8).write.parquet(f"{folder}/events.parquet")
    out = str(tmp_path / "rates")
    q = rates.start_window_counts(table_stream(spark, folder, "events", max_files_per_trigger=1), "ts", "1 hour", out,
                                  str(tmp_path / "ckpt"), {"availableNow": True})
    run_to_completion(q)
    got = {tuple(r) for r in rates.read_window_counts(spark, out).select("window_start", "n").collect()}
    want = {tuple(r) for r in rates.window_counts(events, "ts", "1 hour").select("window_start", "n").collect()}
    assert got == want and sum(n for _, n in got) == events.count()
