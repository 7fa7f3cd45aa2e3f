"""Scored messages on an at-least-once topic, read back with an exactly-once effect (IO6).

A sink without transactions gets the messages of a replayed batch twice. Every message therefore carries a key
that a replay makes again: the query, the batch id, the hash of the message and its number among the equal
messages of the batch. A reader keeps one message per key. A table of (key, value, timestamp) that is only
appended to stands in for the topic where no broker is at hand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MESSAGE_SCHEMA = "key STRING, value STRING, timestamp TIMESTAMP"


def keyed_messages(messages: DataFrame, query: str, batch_id: int) -> DataFrame:
    """``key`` and ``value`` of every message of a batch, the same on each replay of it.

    Equal messages are counted before the shuffle and numbered from their count, so many of them load no task with a sort.
    """
    counted = messages.groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    numbered = counted.select("value", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("number"))
    key = F.concat_ws("-", F.lit(query), F.lit(batch_id), F.sha2("value", 256), F.col("number"))
    return numbered.select(key.alias("key"), "value")


def append_messages(messages: DataFrame, path: str) -> None:
    """Append (key, value) with the time of writing; written again, they stand there twice, as on a topic."""
    messages.withColumn("timestamp", F.current_timestamp()).write.mode("append").parquet(path)


def topic_stream(spark: SparkSession, path: str, max_bytes_per_trigger: int = 256 << 20) -> DataFrame:
    """The appended table as a stream. A micro-batch is bounded by bytes, since a writer may leave many small files."""
    return spark.readStream.schema(MESSAGE_SCHEMA).option("maxBytesPerTrigger", str(max_bytes_per_trigger)).parquet(path)


def _identity(key: str) -> Column:
    # messages of producers that set no key are no copies of one another
    return F.coalesce(F.col(key).cast("string"), F.concat(F.lit("no key "), F.expr("uuid()")))


def distinct_messages(messages: DataFrame, key: str = "key") -> DataFrame:
    """One message per key of a whole topic read as a table; messages without a key all stay."""
    return messages.withColumn("__id", _identity(key)).dropDuplicates(["__id"]).drop("__id")


def distinct_stream(messages: DataFrame, within: str = "1 hour", key: str = "key") -> DataFrame:
    """One message per key of a stream; messages without a key all stay.

    The state holds the keys read in the last ``within`` and no more. The watermark runs on the time of reading, which no
    message is late for, so none is lost however old it is; a copy that is read later than ``within`` after its
    original passes, so ``within`` must exceed the longest stop of the writer that a reader lives through.
    """
    return (messages.withColumns({"__id": _identity(key), "__read_at": F.current_timestamp()})
            .withWatermark("__read_at", within).dropDuplicatesWithinWatermark(["__id"]).drop("__id", "__read_at"))
