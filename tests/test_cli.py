"""The three programs end to end: train from raw CSVs, publish processed rows, score the stream."""

import os
import tempfile

from fixtures import write_reference_raw


def test_train_publish_score(spark):
    from txnscore.__main__ import main
    from txnscore.streaming.scoring import kpi_totals, read_kpis
    root = tempfile.mkdtemp(prefix="txnscore-test-")
    data = os.path.join(root, "data")
    write_reference_raw(spark, f"{data}/train_transaction.csv", f"{data}/train_identity.csv")
    processed, model = os.path.join(root, "processed"), os.path.join(root, "model")
    main(["train", "--data", data, "--processed", processed, "--model", model,
          "--max-depth", "2", "--max-bins", "16", "--step-size", "0.1", "0.2", "--max-iter", "2"])
    msgs = os.path.join(root, "messages")
    main(["publish", "--processed", processed, "--path", msgs])
    out = os.path.join(root, "out")
    main(["score", "--model", model, "--out", out, "--checkpoint", os.path.join(root, "ckpt"), "--path", msgs,
          "--available-now"])
    t = kpi_totals(read_kpis(spark, f"{out}/kpis")).first()
    assert t.n + t.n_quarantined == 40 and t.n > 0


def test_prepare_builds_a_split_once_and_without_a_model(spark, capsys):
    from txnscore.__main__ import main
    root = tempfile.mkdtemp(prefix="txnscore-test-")
    data, processed = os.path.join(root, "data"), os.path.join(root, "test")
    write_reference_raw(spark, f"{data}/test_transaction.csv", f"{data}/test_identity.csv")
    for said in ("built", "already there"):
        main(["prepare", "--data", data, "--processed", processed, "--split", "test"])
        assert said in capsys.readouterr().out
    assert spark.read.parquet(processed).count() == 40 and sorted(os.listdir(root)) == ["data", "test"]
