"""Whole queries give the same rows whatever the shuffle partitioning."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from oracle_check import _rows

KEYS = ["eval_report", "index_categories", "rate_5m", "gauge_from_deltas", "class_weights",
        "average_vectors", "counter_increase", "select_best_candidate", "holdout_split"]


@pytest.mark.parametrize("name", KEYS)
def test_same_rows_for_1_and_64_shuffle_partitions(spark, name):
    results = []
    for parts in ("1", "64"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            results.append(_rows(entry.queries()[name](spark, SF_SMALL).toArrow()))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert results[0] == results[1]


def test_shuffle_joins_give_the_same_rows(spark):
    """With broadcasts off, as for sides beyond Spark's threshold, results still equal the oracle."""
    from oracle_check import compare, duck
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        con = duck(SF_SMALL)
        for name in ("average_vectors", "filter_known_categories"):
            df = entry.queries()[name](spark, SF_SMALL)
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" not in plan, name
            assert compare(df, entry.oracle_sql()[name], con) == [], name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_card_is_split_by_the_skew_join(spark):
    """A third of all transactions on one card: the left join's hot partition is split into
    several tasks (AQE skew join) and no row is lost or duplicated. AQE splits a partition at
    map-output boundaries, so the input has several splits, as any large input does."""
    from pyspark.sql import functions as F
    from txnscore.operators import prepare as prep
    from txnscore.plans.views import ident, txn
    ids = ident(spark, SF_SMALL)
    hot = ids.first().card
    txns = txn(spark, SF_SMALL).repartition(8).withColumn(
        "card", F.when(F.col("txn_id") % 3 == 0, F.lit(hot)).otherwise(F.col("card")))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        joined = prep.join_identity(txns, ids, "card").select("txn_id", "card", "c_name")
        rows = joined.collect()                       # runs this frame's own adaptive plan
        plan = joined._jdf.queryExecution().executedPlan().toString()
        n = len(rows)
    finally:
        for k in conf:
            spark.conf.unset(k)
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert n == txns.count() and len({r.txn_id for r in rows}) == n
    assert "skew=true" in plan
