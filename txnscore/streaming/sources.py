"""Streaming sources (IO5). Kafka is the production source; files stand in for it in tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schema import DRIVER_TABLES
from ..sources.kafka import kafka_stream


def table_stream(spark: SparkSession, sf_dir: str, table: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Parquet file stream of one table (declared schema). A table stored as a directory of part
    files (any large table) is streamed from that directory; a single-file table from its folder
    with a file-name filter."""
    from ..sources.files import is_directory
    r = spark.readStream.schema(DRIVER_TABLES[table]).format("parquet")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    table_path = f"{sf_dir.rstrip('/')}/{table}.parquet"
    if is_directory(spark, table_path):
        return r.load(table_path)
    return r.option("pathGlobFilter", f"{table}.parquet").load(sf_dir)


def message_stream(spark: SparkSession, source: str, path: str | None = None, servers: str | None = None,
                   topic: str | None = None, max_files_per_trigger: int | None = None,
                   max_offsets_per_trigger: int | None = None, max_bytes_per_trigger: int | None = None) -> DataFrame:
    """JSON messages as a ``json`` string column, from Kafka (``source='kafka'``) or text files;
    the per-trigger limits keep every micro-batch bounded whatever the backlog."""
    if source == "kafka":
        return kafka_stream(spark, servers, topic, max_offsets_per_trigger=max_offsets_per_trigger)
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if max_bytes_per_trigger:
        r = r.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    return r.load(path).withColumnRenamed("value", "json")
