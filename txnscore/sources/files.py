"""Raw and processed feature tables (IO1-IO4).

Raw tables are read with a declared schema (CSV with header, or Parquet). Processed tables are
Parquet, written with the natural partitioning of the job and read back by column name, so a
column order difference between writer and reader cannot shift values.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import LABEL, SELECTED_FEATURES


def scan_raw(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet") -> DataFrame:
    """IO1: scan a raw transaction or identity table with a declared schema."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        return reader.option("header", "true").option("mode", "PERMISSIVE").csv(path)
    return reader.format(fmt).load(path)


def scan_csv_by_name(spark: SparkSession, path: str, types: dict[str, str]) -> DataFrame:
    """IO1 for wide CSVs: take column names from the header (first line only; no inference pass),
    cast the named columns to their declared types by name (a CSV schema would apply by
    position; a malformed value becomes null), keep the others as strings."""
    raw = spark.read.option("header", "true").option("mode", "PERMISSIVE").csv(path)
    return raw.select(*[F.col(f"`{c}`").try_cast(types[c]).alias(c) if c in types else F.col(f"`{c}`")
                        for c in raw.columns])


def scan_features(spark: SparkSession, path: str, columns: list[str] | None = None,
                  label: str | None = LABEL) -> DataFrame:
    """IO2: scan a processed feature table by name; the label is appended when the table has it."""
    df = spark.read.parquet(path)
    names = list(columns or SELECTED_FEATURES)
    if label and label in df.columns and label not in names:
        names.append(label)
    return df.select(*names)


def write_features(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """IO3: overwrite a processed table as Parquet, one file per task (no coalesce to one writer)."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system of ``path`` (local, HDFS, object store)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return bool(hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath))


def _file_system(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def file_statuses(spark: SparkSession, paths: list[str]) -> list[list]:
    """[path, length, modification time] of each file (metadata that a scan lists anyway)."""
    out = []
    for path in paths:
        # inputFiles() gives encoded URIs
        hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(spark.sparkContext._jvm.java.net.URI(path))
        status = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(hpath)
        out.append([path, status.getLen(), status.getModificationTime()])
    return out


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files under a folder."""
    fs, hpath = _file_system(spark, path)
    return int(fs.getContentSummary(hpath).getLength())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file written by the driver (manifests)."""
    fs, hpath = _file_system(spark, path)
    out = fs.create(hpath, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, hpath = _file_system(spark, path)
    source = fs.open(hpath)
    try:
        return str(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8"))
    finally:
        source.close()


def rename(spark: SparkSession, path: str, to: str) -> None:
    """Rename a file or folder; raises where the file system refuses or ``to`` exists."""
    fs, hpath = _file_system(spark, path)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(to)
    # renaming a folder onto one that exists would move it inside
    if fs.exists(target) or not fs.rename(hpath, target):
        raise OSError(f"cannot rename {path} to {to}")


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder of this package's own making."""
    fs, hpath = _file_system(spark, path)
    fs.delete(hpath, True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; none if it does not exist."""
    fs, hpath = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(hpath)) if fs.exists(hpath) else []


def is_directory(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath) and fs.getFileStatus(hpath).isDirectory())


def is_materialized(spark: SparkSession, path: str) -> bool:
    """IO4: a table counts as present only when its ``_SUCCESS`` marker exists."""
    return path_exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def materialize_if_missing(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> bool:
    """IO4: run ``build`` and write it to ``path`` only when the output is absent. True if built.

    The table is written beside ``path`` and renamed into place when it is whole, so nobody ever sees half
    a table. Of two builders at once the first one publishes; the other one drops its own copy and returns False. What a
    crashed builder left at ``path`` itself (a folder without its marker) is set aside, not read.
    """
    path = path.rstrip("/")
    if is_materialized(spark, path):
        return False
    staging = f"{path}.staging-{uuid.uuid4().hex[:12]}"
    build().write.parquet(staging)
    if is_materialized(spark, path):
        delete(spark, staging)
        return False
    if path_exists(spark, path):
        rename(spark, path, f"{path}.broken-{uuid.uuid4().hex[:12]}")
    try:
        rename(spark, staging, path)
    except OSError:
        if not is_materialized(spark, path):
            raise
        delete(spark, staging)
        return False
    return True
