"""IO4 publication, ST6 compaction and the join with a hot key: nothing half, lost, doubled or in one task."""

import pytest
from pyspark.sql import functions as F

from txnscore.operators import prepare
from txnscore.sources import files
from txnscore.streaming import rates


def test_a_crashed_or_second_builder_never_shows_half_a_table(spark, tmp_path, monkeypatch):
    path, rows = f"{tmp_path}/t", spark.range(100)
    with pytest.raises(RuntimeError):
        files.materialize_if_missing(spark, path, lambda: (_ for _ in ()).throw(RuntimeError("crash")))
    spark.range(3).write.parquet(path)                       # what a crash of another writer left: no marker
    (tmp_path / "t" / "_SUCCESS").unlink()
    assert files.materialize_if_missing(spark, path, lambda: rows) and spark.read.parquet(path).count() == 100

    def slower():                                            # another builder publishes while this one works
        files.materialize_if_missing(spark, f"{tmp_path}/u", lambda: rows)
        return spark.range(7)
    assert files.materialize_if_missing(spark, f"{tmp_path}/u", slower) is False
    assert spark.read.parquet(f"{tmp_path}/u").count() == 100
    assert files.materialize_if_missing(spark, path, lambda: pytest.fail("must skip")) is False


def _batch(spark, out, i, n):
    rows = spark.createDataFrame([(f"2024-01-01 0{k % 3}:10:00",) for k in range(n)], "ts string").select(F.col("ts").cast("timestamp_ntz").alias("ts"))
    rates.window_counts(rows, "ts", "1 hour").write.mode("overwrite").parquet(f"{out}/batch_id={i}")


def test_compaction_loses_and_doubles_nothing(spark, tmp_path, monkeypatch):
    out = f"{tmp_path}/rates"
    total = lambda: sum(r.n for r in rates.read_window_counts(spark, out).collect())
    for i in range(4):
        _batch(spark, out, i, 10 + i)
    assert total() == 46
    assert rates.compact(spark, out, 1) == 1 and total() == 46
    monkeypatch.setattr(rates, "rename", lambda *a: (_ for _ in ()).throw(OSError("crash before the switch")))
    with pytest.raises(OSError):
        rates.compact(spark, out, 3)
    assert total() == 46
    monkeypatch.undo()
    monkeypatch.setattr(rates, "delete", lambda *a: (_ for _ in ()).throw(OSError("crash after the switch")))
    with pytest.raises(OSError):
        rates.compact(spark, out, 3)
    assert total() == 46
    monkeypatch.undo()
    _batch(spark, out, 3, 13)                                # a replay of a batch that the base table covers
    _batch(spark, out, 4, 100)
    assert total() == 146 and rates.compact(spark, out, 4) == 3 and total() == 146
    assert rates.compact(spark, out, 4) == 3


def test_a_hot_key_spreads_over_tasks(spark):
    txns = spark.range(0, 30_000, 1, 64).select("id", F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 997).alias("card"))
    ids = spark.range(-1, 900).select(F.col("id").alias("card"), (F.col("id") * 2).alias("x"))
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "64", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        out = prepare.join_identity(txns, ids, "card", heavy=1000)
        largest = out.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
        rows = sorted(map(str, out.collect()))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert rows == sorted(map(str, txns.join(ids, ["card"], "left").collect()))
    assert largest < 2000   # 10 000 rows have the hot key
