"""Reads of the driver's parquet tables with declared schemas (no inference pass)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schema import DRIVER_TABLES


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Scan ``{sf_dir}/{name}.parquet``; selecting ``columns`` prunes the parquet ReadSchema."""
    df = spark.read.schema(DRIVER_TABLES[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df
