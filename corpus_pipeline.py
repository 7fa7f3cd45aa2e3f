"""Corpus pipeline over ``documents``: quality rules, line dedup, near-dedup, decontamination, mixing.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. The stages keep
all columns of their input, also unknown ones; null ids, null texts and empty tables are handled as
the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnscore.llm.decontam import drop_contaminated
from txnscore.llm.line_dedup import dedup_lines
from txnscore.llm.mixing import mixed
from txnscore.llm.near_dup import drop_near_duplicates
from txnscore.llm.quality_rules import keep_clean
from txnscore.llm.tables import table
from txnscore.session import scratch_path


def _columns(docs: DataFrame, text, also: dict | None = None) -> list:
    """The columns of ``docs`` with a new text, its length in n_chars, and other replacements."""
    new = {"text": text, "n_chars": F.length(text).cast("long")} | (also or {})
    return [new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go, and with them the documents that fail the rules or lose too much text."""
    return keep_clean(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat, exactly or nearly, stay in one place; a document of which no word is
    left, because all its lines stay elsewhere, goes. One without removed lines stays as it is."""
    out = dedup_lines(docs)
    left = F.col("text").isNull() | (F.col("__n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return out.filter(left).select(_columns(docs, F.col("text")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, similarity 0.8 or more."""
    return drop_near_duplicates(docs, shingle=5, percent=80, half=2, collections=12)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, or a 13-word piece of one, go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with size, source_size, target, copies (how many times
    each is read) and taken (words, repeats counted). Equal rows stay repeated."""
    return mixed(docs)


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("minhash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("source mixing", mixture),
]

#: SQL cannot express the fuzzy stages; tests/llm compares them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each written as Parquet in the shared folder and reread."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"pipeline-{k}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
