"""Sources: declared-schema CSV scan, by-name processed scan, materialize-if-missing, API train."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from txnscore.schema import DRIVER_TABLES
from txnscore.sources import files
from txnscore.sources.tables import read_table


def test_csv_scan_with_declared_schema(spark):
    root = tempfile.mkdtemp(prefix="txnscore-test-")
    src = read_table(spark, SF_SMALL, "customer")
    src.write.option("header", "true").csv(os.path.join(root, "c"))
    back = files.scan_raw(spark, os.path.join(root, "c"), DRIVER_TABLES["customer"], fmt="csv")
    assert back.schema == src.schema
    assert back.exceptAll(src).count() == 0 and src.exceptAll(back).count() == 0


def test_processed_scan_by_name_and_materialize_once(spark):
    root = tempfile.mkdtemp(prefix="txnscore-test-")
    path = os.path.join(root, "p")
    df = read_table(spark, SF_SMALL, "events").withColumn("isFraud", F.lit(1))
    assert files.materialize_if_missing(spark, path, lambda: df) is True
    assert files.materialize_if_missing(spark, path, lambda: df) is False
    back = files.scan_features(spark, path, ["value", "event_id"])
    assert back.columns == ["value", "event_id", "isFraud"]
    assert back.count() == df.count()


def test_api_train_gbt_roundtrip(spark):
    """The reference-shaped training entry on a processed table built from the driver tables."""
    from txnscore.api import TrainConfig, train_gbt
    from txnscore.plans.views import ml_events
    root = tempfile.mkdtemp(prefix="txnscore-test-")
    data = ml_events(spark, SF_SMALL)
    from txnscore.operators.features import feature_pipeline
    cfg = TrainConfig(model_path=os.path.join(root, "m"), label="is_fraud",
                      grid=[dict(max_depth=2, max_bins=16, step_size=0.1, max_iter=3)],
                      features=feature_pipeline(["value", "k"], ["user_bucket"], "entity_id", "device_info"))
    _, candidates = train_gbt(spark, data, cfg)
    assert candidates.where("is_best").count() == 1
    _, metrics = train_gbt(spark, data, cfg)              # second call loads the saved model
    assert metrics.count() == 1


def test_k_fold_cross_validation(spark):
    from txnscore.operators import models as ml
    from txnscore.operators.features import feature_pipeline
    from txnscore.plans.views import ml_events
    data = ml_events(spark, SF_SMALL)
    pipe = feature_pipeline(["value", "k"], ["user_bucket"], "entity_id", None)
    grid = ml.param_grid(max_depth=[2, 3], max_bins=[16], step_size=[0.1])
    out = ml.cross_validate(data, pipe, grid, lambda **p: ml.gbt("is_fraud", max_iter=3, **p), k=2,
                            key="event_id", label="is_fraud")
    rows = out.collect()
    assert len(rows) == 2 and sum(r.is_best for r in rows) == 1
    assert all(0.0 <= r.accuracy <= 1.0 for r in rows)


def test_api_train_program(spark):
    """prepare (materialized once) -> scan by name -> train-or-load -> evaluate, on txn/ident."""
    from txnscore.api import TrainConfig, train
    from txnscore.operators.features import feature_pipeline
    from txnscore.plans.views import TXN_COLUMNS, ident, txn
    root = tempfile.mkdtemp(prefix="txnscore-test-")
    feats = feature_pipeline(["amount", "event_timestamp", "addr1", "D4"], ["product", "c_mktsegment"],
                             "entity_id", "c_name")
    cfg = TrainConfig(model_path=os.path.join(root, "m"), label="is_fraud", features=feats,
                      grid=[dict(max_depth=2, max_bins=16, step_size=0.1, max_iter=3)], hash_split_key="txn_id")
    processed = os.path.join(root, "processed")
    _, candidates = train(spark, cfg, txn(spark, SF_SMALL), ident(spark, SF_SMALL), processed, TXN_COLUMNS)
    assert files.is_materialized(spark, processed)
    assert candidates.where("is_best").count() == 1


def test_reference_shaped_csv_to_trained_model(spark):
    """Raw transaction/identity CSVs with the reference's column names -> prepare (join,
    offsets, fill, timestamp, entity key, the 67 selected features + label, materialized once)
    -> grid search -> saved pipeline that scores the processed rows."""
    from pyspark.ml import PipelineModel
    from pyspark.sql import types as T
    from txnscore.api import TrainConfig, train
    from txnscore.schema import SELECTED_FEATURES
    from fixtures import write_reference_raw
    root = tempfile.mkdtemp(prefix="txnscore-test-")
    raw = os.path.join(root, "raw")
    txn_schema, id_schema, id_rows = write_reference_raw(spark, f"{raw}/t", f"{raw}/i")
    txns = files.scan_raw(spark, f"{raw}/t", txn_schema, fmt="csv")
    ids = files.scan_raw(spark, f"{raw}/i", id_schema, fmt="csv")
    cfg = TrainConfig(model_path=os.path.join(root, "model"),
                      grid=[dict(max_depth=2, max_bins=16, step_size=0.1, max_iter=2)])
    processed = os.path.join(root, "processed")
    _, candidates = train(spark, cfg, txns, ids, processed)
    assert candidates.where("is_best").count() == 1
    table = spark.read.parquet(processed)
    assert table.columns == SELECTED_FEATURES + ["isFraud"] and table.count() == 40
    assert table.where("DeviceInfo = 'unknown'").count() == 40 - len(id_rows)
    zero_addr = txns.where("addr1 IS NULL OR addr1 = 0.0").count()              # nulls are filled with 0
    assert zero_addr > txns.where("addr1 = 0.0").count()
    assert table.where("split(ENTITY_ID, '_')[1] = '0.0'").count() == zero_addr
    scored = PipelineModel.load(cfg.model_path).transform(table)
    assert scored.count() == 40 and "probability" in scored.columns


def test_csv_read_by_header_name_not_position(spark):
    """D1: a file written in another column order than the declared types are listed in is
    still read correctly, because columns are matched by header name."""
    root = tempfile.mkdtemp(prefix="txnscore-test-")
    src = read_table(spark, SF_SMALL, "customer")
    shuffled = src.select("c_mktsegment", "c_acctbal", "c_custkey", "c_name", "c_nationkey")
    shuffled.write.option("header", "true").csv(os.path.join(root, "c"))
    types = {"c_custkey": "long", "c_nationkey": "int", "c_acctbal": "double"}   # in another order
    back = files.scan_csv_by_name(spark, os.path.join(root, "c"), types)
    assert dict(back.dtypes)["c_custkey"] == "bigint" and dict(back.dtypes)["c_acctbal"] == "double"
    got = back.select(*src.columns)
    assert got.exceptAll(src).count() == 0 and src.exceptAll(got).count() == 0


def test_api_train_rf_weighted_then_loaded(spark):
    from txnscore.api import train_rf
    from txnscore.operators.features import feature_pipeline
    from txnscore.plans.views import ml_events
    root = tempfile.mkdtemp(prefix="txnscore-test-")
    data = ml_events(spark, SF_SMALL)
    feats = feature_pipeline(["value", "k"], ["user_bucket"], "entity_id", None)
    path = os.path.join(root, "rf")
    _, m1 = train_rf(spark, data, path, label="is_fraud", features=feats, hash_split_key="event_id",
                     num_trees=5, max_depth=3, max_bins=16)
    _, m2 = train_rf(spark, data, path, label="is_fraud", features=feats, hash_split_key="event_id")
    r1, r2 = m1.first(), m2.first()                      # second call loads the saved forest
    assert r1.accuracy == r2.accuracy and r1.area_under_roc == r2.area_under_roc


def test_materialization_guard_is_per_split(spark):
    """D12: each split's processed table is built when it is missing, independently."""
    from txnscore.api import prepare_split
    from txnscore.plans.views import TXN_COLUMNS, ident, txn
    root = tempfile.mkdtemp(prefix="txnscore-test-")
    t, i = txn(spark, SF_SMALL), ident(spark, SF_SMALL)
    train_path, test_path = os.path.join(root, "train"), os.path.join(root, "test")
    assert prepare_split(spark, t, i, train_path, TXN_COLUMNS) is True
    assert prepare_split(spark, t, i, test_path, TXN_COLUMNS) is True      # not skipped by train's
    assert prepare_split(spark, t, i, train_path, TXN_COLUMNS) is False
    assert prepare_split(spark, t, i, test_path, TXN_COLUMNS) is False
