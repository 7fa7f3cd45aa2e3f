"""Reads and small helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, let_workers_import

#: White space between words, as in ``[^\x20\x09-\x0D]+``.
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read by Spark from wherever ``sf_dir`` is."""
    let_workers_import(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(doc_id: Column, n: int) -> Column:
    """Remainder of the crc32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % n


def cut(df: DataFrame) -> DataFrame:
    """Materialize in the shared checkpoint folder and cut the lineage (reliable, not local)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def discard(df: DataFrame) -> None:
    """Delete the files of a table that ``cut`` materialized and that nothing reads any more."""
    spark = df.sparkSession
    where = df._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
    if where.isDefined():
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where.get())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def word_count(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+`` (0 for null): blanks whose successor is a word
    character start a word, so one regular expression pass counts them."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
