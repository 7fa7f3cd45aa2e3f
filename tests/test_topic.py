"""IO6: message keys that a replay makes again, and readers that keep one message per key."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from oracle_check import compare, duck
from txnscore.plans import streams
from txnscore.plans.oracle import SQL
from txnscore.streaming.scoring import run_to_completion
from txnscore.streaming.topic import append_messages, distinct_messages, distinct_stream, keyed_messages, topic_stream


def test_keys_repeat_on_replay_and_differ_otherwise(spark):
    values = spark.createDataFrame([("a",)] * 300 + [("b",), ("c",), ("",)], "value string")
    first = {(r.key, r.value) for r in keyed_messages(values, "q", 7).collect()}
    again = {(r.key, r.value) for r in keyed_messages(values.repartition(5), "q", 7).collect()}
    assert first == again and len(first) == 303 and len({k for k, _ in first}) == 303
    for query, batch in (("q", 8), ("p", 7)):
        other = {r.key for r in keyed_messages(values, query, batch).collect()}
        assert not other & {k for k, _ in first}
    assert keyed_messages(values.limit(0), "q", 7).count() == 0


def test_replayed_batch_leaves_the_read_rows_unchanged(spark):
    topic = streams._replayed_topic(spark, SF_SMALL)
    written = spark.read.parquet(topic)
    once = distinct_messages(written)
    assert written.count() > once.count()
    assert compare(streams._scored_fields(once), SQL["stream_topic_once"], duck(SF_SMALL)) == []


def read_on(spark, topic, out, ckpt, within="1 hour"):
    q = (distinct_stream(topic_stream(spark, topic, 1), within).writeStream.format("parquet")
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start(out))
    run_to_completion(q)
    return sorted(r.value for r in spark.read.parquet(out).collect())


def test_stream_reader_over_restarts_old_messages_and_missing_keys(spark, tmp_path):
    topic, out, ckpt = (str(tmp_path / n) for n in ("topic", "out", "ckpt"))
    values = spark.createDataFrame([("a",), ("a",), ("b",)], "value string")
    messages = keyed_messages(values, "q", 0)
    append_messages(messages, topic)
    assert read_on(spark, topic, out, ckpt) == ["a", "a", "b"]
    append_messages(messages, topic)  # the batch is replayed while the reader is down
    append_messages(keyed_messages(values, "q", 1), topic)
    assert read_on(spark, topic, out, ckpt) == sorted(["a", "a", "b"] * 2)
    # messages written long ago are not late, and those without a key are no copies of each other
    (spark.createDataFrame([(None, "x"), (None, "x"), ("k", "old")], "key string, value string")
     .withColumn("timestamp", F.lit("2001-01-01").cast("timestamp")).write.mode("append").parquet(topic))
    assert read_on(spark, topic, out, ckpt) == sorted(["a", "a", "b"] * 2 + ["x", "x", "old"])
    assert distinct_messages(spark.read.parquet(topic)).count() == 9
