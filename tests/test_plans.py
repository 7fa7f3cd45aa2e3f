"""Plan discipline for every registered relational query: no cartesian products or nested-loop
joins, no single-partition window directly over a table scan, and driver-table scans read only
the columns they need with filters pushed to Parquet where the query filters."""

import re

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL

MODEL_KEYS = {"gbt_train_eval", "gbt_score", "gbt_baseline", "rf_train_eval", "gbt_grid_search",
              "train_pipeline", "model_roundtrip", "word2vec_docs"}
STREAM_KEYS = {"stream_ingest", "stream_score_sink", "stream_batch_kpis", "stream_rate", "publish_json",
               "roundtrip_features"}
KEYS = sorted(set(entry.queries()) - MODEL_KEYS - STREAM_KEYS)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", KEYS)
def test_no_cartesian_or_nested_loop(spark, name):
    plan = _plan(entry.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_scans_are_pruned(spark):
    """event_timestamp needs the order key and date only; the other order columns are not read."""
    plan = _plan(entry.queries()["event_timestamp"](spark, SF_SMALL))
    read = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert read == ["o_orderkey:bigint,o_orderdate:timestamp_ntz"]


def test_filters_are_pushed_to_the_scan_and_the_identity_join_reads_every_customer(spark):
    from txnscore.plans.views import ident
    plan = _plan(ident(spark, SF_SMALL).where("c_mktsegment = 'BUILDING'"))
    assert "PushedFilters: [IsNotNull(c_mktsegment), EqualTo(c_mktsegment,BUILDING)" in plan
    plan = _plan(entry.queries()["left_join_identity"](spark, SF_SMALL))
    assert "BUILDING" not in plan and "ReadSchema: struct<c_custkey:bigint,c_name:string,c_nationkey:" in plan


def test_class_weight_join_broadcasts_bounded_table(spark):
    plan = _plan(entry.queries()["class_weights"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
