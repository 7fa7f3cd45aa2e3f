"""Edge rows (FIXTURES F6)."""

import math

from pyspark.sql import functions as F

from txnscore.functions.columns import approval_rate, fraud_flag, high_risk_flag
from txnscore.operators import aggregates as agg
from txnscore.operators import evaluate as ev_ops
from txnscore.operators import features as fe
from txnscore.operators import prepare as prep
from txnscore.operators import reporting as rp
from txnscore.operators.ordering import global_row_index, ordered_prefix_sums


def test_fill_values(spark):
    schema = "s STRING, d DOUBLE, i INT, b BOOLEAN"
    df = spark.createDataFrame([(None, None, None, None), ("x", float("nan"), 3, True)], schema)
    rows = prep.fill_missing(df).orderBy("i").collect()
    assert (rows[0].s, rows[0].d, rows[0].i, rows[0].b) == ("unknown", 0.0, 0, None)
    assert rows[1].d == 0.0


def test_null_addr_and_d1_entity(spark):
    schema = "TransactionID LONG, card1 INT, TransactionDT INT, D4 DOUBLE"
    txns = spark.createDataFrame([(1, 10409, 18403224, None)], schema)
    ids = spark.createDataFrame([], "TransactionID LONG, addr1 DOUBLE, D1 DOUBLE, DeviceInfo STRING")
    cols = prep.TxnColumns(features=("TransactionID", "ENTITY_ID", "D4", "addr1", "DeviceInfo"))
    out = prep.prepare(txns, ids, cols).first()
    assert out.ENTITY_ID == f"10409_0.0_{math.floor(18403224 / 86400)}"
    assert out.D4 == 0.0 and out.addr1 == 0.0 and out.DeviceInfo == "unknown"
    normalized = prep.normalize_offsets(txns, ["D4"], "TransactionDT").first()
    assert normalized.D4 is None


def test_json_quarantine_reasons(spark):
    msgs = spark.createDataFrame([('{"a": 1, "b": "x"}',), ("not json",), ('{"a": "str", "b": "x"}',),
                                  ('{"b": "x"}',), ('{"a": 2, "b": "y", "extra": 5}',), (None,)], "json STRING")
    parsed = prep.parse_json(msgs, "json", "a INT, b STRING")
    out = parsed.select("a", "b", prep.quarantine_reason(parsed, "json", ["a"]).alias("reason")).collect()
    reasons = [r.reason for r in out]
    assert reasons == [None, "malformed_json", "malformed_json", "missing_a", None, "null_message"]
    assert "extra" not in parsed.columns


def test_unseen_or_null_category_is_quarantined_not_lost(spark):
    fit = spark.createDataFrame([("a",), ("b",)], "c STRING")
    data = spark.createDataFrame([(1, "a"), (2, "z"), (3, None)], "id INT, c STRING")
    labels = prep.category_labels(fit, "c")
    kept = {r.id for r in prep.filter_known_categories(data, labels, "c").collect()}
    lost = {r.id for r in prep.unknown_categories(data, labels, "c").collect()}
    assert kept == {1} and lost == {2, 3}


def test_equal_counts_index_alphabetically(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "x STRING")
    idx = {r.x: r.x_index for r in fe.category_index_table(df, "x").collect()}
    assert idx == {"c": 0.0, "a": 1.0, "b": 2.0}


def test_word2vec_empty_and_unknown_tokens_give_zero_vector(spark):
    from pyspark.ml import Pipeline
    train = spark.createDataFrame([("a b",), ("b c",)], "t STRING")
    model = Pipeline(stages=[fe.tokenizer_stage("t", "tok", " "), fe.word2vec_stage("tok", "v", vector_size=4)]).fit(train)
    test = spark.createDataFrame([("zz yy",)], "t STRING")
    from pyspark.ml.functions import vector_to_array
    v = model.transform(test).select(vector_to_array("v").alias("a")).first().a
    assert v == [0.0, 0.0, 0.0, 0.0]
    w2v = model.stages[-1]
    empty = spark.createDataFrame([([],)], "tok ARRAY<STRING>")
    assert w2v.transform(empty).select(vector_to_array("v")).first()[0] == [0.0, 0.0, 0.0, 0.0]


def test_flags_edges(spark):
    df = spark.createDataFrame([(0.4, None), (0.4000001, 1.0), (None, 0.0)], "p DOUBLE, pred DOUBLE")
    out = df.select(high_risk_flag("p").alias("h"), fraud_flag("pred").alias("f")).collect()
    assert [(r.h, r.f) for r in out] == [(False, False), (True, True), (False, False)]


def test_empty_batch_kpis(spark):
    empty = spark.createDataFrame([], "predicted_fraud BOOLEAN, is_high_risk BOOLEAN")
    r = agg.batch_kpis(empty).first()
    assert (r.n, r.n_fraud, r.n_high_risk, r.approval_rate) == (0, 0, 0, None)
    assert spark.range(1).select(approval_rate(F.lit(0), F.lit(0))).first()[0] is None


def test_one_class_weight_and_undefined_auc(spark):
    df = spark.createDataFrame([(1, 0), (2, 0), (3, None)], "id INT, isFraud INT")
    w = agg.with_class_weights(df, "isFraud").collect()
    assert sorted(r.id for r in w) == [1, 2] and all(r.weight == 1.0 for r in w)
    scored = spark.createDataFrame([(0.0, 0.3), (0.0, 0.9)], "label DOUBLE, score DOUBLE")
    r = ev_ops.auc_roc_pr(scored, "label", "score").first()
    assert r.area_under_roc is None and r.area_under_pr is None


def test_counter_reset_increase(spark):
    df = spark.createDataFrame([("s", 1, 5), ("s", 2, 9), ("s", 3, 2), ("s", 4, 6)], "k STRING, t INT, c LONG")
    out = rp.counter_increase(df, ["k"], "t", "c", 1.0).orderBy("t").collect()
    assert [r.increase for r in out] == [5, 4, 2, 4]


def test_histogram_le_cumulative(spark):
    df = spark.createDataFrame([(0.05,), (0.5,), (3.0,), (100.0,), (None,)], "v DOUBLE")
    rows = {r.le: r for r in agg.histogram_le(df, "v").collect()}
    assert rows["0.1"].cumulative_count == 1 and rows["0.5"].cumulative_count == 2
    assert rows["5.0"].cumulative_count == 3 and rows["60.0"].cumulative_count == 3
    assert rows["+Inf"].cumulative_count == 4 and rows["+Inf"].value_count == 4


def test_global_index_and_prefix_sums_are_partition_invariant(spark):
    base = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k"), (F.col("id") % 3).alias("v"))
    expect = None
    for parts in (1, 8):
        df = base.repartition(parts)
        idx = global_row_index(df, [F.col("k").asc()], "i").select("k", "i").orderBy("k").collect()
        assert [r.i for r in idx] == list(range(5000))
        cum = ordered_prefix_sums(df, [F.col("k").asc()], ["v"]).orderBy("k").collect()
        got = [r.cum_v for r in cum]
        expect = expect or got
        assert got == expect


def test_hash_split_is_partition_invariant(spark):
    base = spark.range(0, 2000)
    a = {r.id: r.split for r in prep.with_split(base.repartition(1), "id", [0.7, 0.3], 1409).collect()}
    b = {r.id: r.split for r in prep.with_split(base.repartition(7), "id", [0.7, 0.3], 1409).collect()}
    assert a == b and 0.6 < sum(1 for v in a.values() if v == 0) / 2000 < 0.8


def test_every_class_keeps_its_rows(spark):
    """Weights cover any label value; only null labels drop out."""
    from txnscore.operators.aggregates import with_class_weights
    df = spark.createDataFrame([(0,), (1,), (2,), (2,), (-1,), (None,)], "isFraud int")
    got = sorted((r.isFraud, r.weight) for r in with_class_weights(df).collect())
    assert got == [(-1, 5.0), (0, 5.0), (1, 5.0), (2, 2.5), (2, 2.5)]


def test_areas_of_counts_beyond_bigint_products(spark):
    from txnscore.operators.evaluate import auc_from_score_counts
    n = 4_000_000_000
    row = auc_from_score_counts(spark.createDataFrame([(0.9, n, 0), (0.1, 0, n)], "score double, pos long, neg long")).first()
    assert row.area_under_roc == 1.0 and row.area_under_pr == 1.0


def test_split_spreads_ids_that_share_their_low_bits(spark):
    from pyspark.sql import functions as F
    from txnscore.operators.prepare import with_split
    for shift in (22, 33):
        ids = spark.range(20_000).select(F.shiftleft("id", shift).alias("id"))
        share = with_split(ids, "id", [0.7, 0.3], 1409).agg(F.avg("split")).first()[0]
        assert 0.28 < share < 0.32


def test_unreadable_model_is_not_overwritten(spark, tmp_path):
    import pytest
    from txnscore.operators.models import train_or_load
    path = tmp_path / "model"
    path.mkdir()
    (path / "junk").write_text("x")
    with pytest.raises(Exception):
        train_or_load(spark, str(path), lambda: pytest.fail("must not train"))
    assert (path / "junk").read_text() == "x"
