"""Kafka source and sink settings (IO5, IO6).

The Kafka connector jar is not on this image's classpath, so these are exercised in tests only
through the file source; the options are those of the Spark Kafka integration.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_stream(spark: SparkSession, servers: str, topic: str, starting_offsets: str = "earliest",
                 max_offsets_per_trigger: int | None = None) -> DataFrame:
    """IO5: subscribe to ``topic``; ``value`` (bytes) becomes the ``json`` string column.
    ``max_offsets_per_trigger`` bounds each micro-batch (the scoring query persists one batch
    at a time, so its size must not follow the backlog)."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets)
              .option("failOnDataLoss", "false"))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    raw = reader.load()
    return raw.selectExpr("CAST(value AS STRING) AS json")


def kafka_sink_options(servers: str, topic: str) -> dict[str, str]:
    """IO6: options for ``writeStream.format('kafka')`` (the frame must have a ``value`` column)."""
    return {"kafka.bootstrap.servers": servers, "topic": topic}
