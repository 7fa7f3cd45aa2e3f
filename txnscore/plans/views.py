"""How the driver tables map onto the transaction-scoring data model.

* ``txn`` (orders): one transaction per order; ``txn_dt`` = seconds since 1995-01-01,
  ``card`` = customer, ``product`` = order priority, label ``is_fraud`` = status 'F'.
* ``ident`` (customer): identity side keyed by ``card`` (customers without an order and cards
  without a customer stay unmatched); the nation key plays the address, missing for one nation in five, the
  account balance both day-offset roles (D1 raw, D4 normalized), missing where it is negative.
* ``ev`` (events): ``k`` parsed from the JSON ``props``; label ``is_fraud`` = event type 'error'.
* ``scored`` (ev): a fixed logistic margin m = (k - 50) / 50 stands in for a model, so every
  scoring and KPI operator can be checked exactly in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.prepare import TxnColumns
from ..operators.scoring import score_from_margin, with_score_flags
from ..schema import PROPS_SCHEMA
from ..sources.tables import read_table

TXN_ORIGIN = "1995-01-01 00:00:00"
FRAUD_STATUS = "F"
FRAUD_EVENT = "error"

TXN_COLUMNS = TxnColumns(
    key="card", offset_seconds="txn_dt", card="card", addr="addr1", entity_day="D1",
    offsets=("D4",), label="is_fraud", event_timestamp="event_timestamp", entity_id="entity_id",
    features=("txn_id", "amount", "event_timestamp", "entity_id", "product", "c_name",
              "c_mktsegment", "addr1", "card", "D4"),
)


def txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders",
                   ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"])
    return o.select(
        F.col("o_orderkey").alias("txn_id"),
        F.timestamp_diff("SECOND", F.lit(TXN_ORIGIN).cast("timestamp_ntz"), F.col("o_orderdate")).alias("txn_dt"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_custkey").alias("card"),
        F.col("o_orderpriority").alias("product"),
        (F.col("o_orderstatus") == F.lit(FRAUD_STATUS)).cast("int").alias("is_fraud"),
    )


def ident(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("card"), "c_name", "c_mktsegment",
        F.when(F.col("c_nationkey") % 5 != 0, F.col("c_nationkey").cast("double")).alias("addr1"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("D1"), F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("D4"))


def ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev_from(read_table(spark, sf_dir, "events"))


def ev_from(e: DataFrame) -> DataFrame:
    """events columns -> ev (works on batch and streaming frames)."""
    return e.select(
        "event_id", "ts", "user_id", "event_type", "value",
        F.from_json(F.col("props"), PROPS_SCHEMA).getField("k").alias("k"),
        (F.col("event_type") == F.lit(FRAUD_EVENT)).cast("int").alias("is_fraud"),
    )


def margin_of(k_col: str = "k") -> F.Column:
    return (F.col(k_col) - F.lit(50)) / F.lit(50.0)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_from(ev(spark, sf_dir))


def scored_from(e: DataFrame) -> DataFrame:
    """ev -> scored with the fixed margin (batch or streaming)."""
    return with_score_flags(score_from_margin(e.withColumn("margin", margin_of()), "margin"))


def ml_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ev shaped for the encoder chain: numeric inputs, a category (user bucket), an entity key
    ``user_k_day`` for hashing, and a short text for the Word2Vec stage."""
    e = ev(spark, sf_dir)
    day = F.datediff(F.to_date("ts"), F.lit("1970-01-01").cast("date"))
    return e.select(
        "event_id", "ts", "is_fraud", "value", F.col("k").cast("double").alias("k"),
        (F.col("user_id") % 5).cast("string").alias("user_bucket"),
        F.concat_ws("_", F.col("user_id").cast("string"), F.col("k").cast("string"), day.cast("string")).alias("entity_id"),
        F.concat_ws(" ", F.lit("user"), (F.col("user_id") % 7).cast("string")).alias("device_info"),
    )
