"""Command line: the three programs of a scoring deployment.

  python -m txnscore prepare --data DIR --processed DIR [--split train|test]
  python -m txnscore train   --data DIR --processed DIR --model DIR [--grid-parallelism N]
  python -m txnscore score   --model DIR --out DIR --checkpoint DIR (--path DIR | --servers S --topic T)
  python -m txnscore publish --processed DIR (--path DIR | --servers S --topic T)

``prepare`` materializes the processed table of one split, without a model. ``train`` reads ``{data}/train_transaction.csv`` and ``{data}/train_identity.csv`` (header, types
by name), materializes the processed table once, grid-searches GBT on a holdout and saves the
best pipeline. ``score`` runs the streaming service (10 s trigger) until stopped. ``publish``
sends the processed rows as JSON messages, one distributed write.
"""

from __future__ import annotations

import argparse

from . import api
from .operators.models import param_grid
from .schema import GRID_MAX_BINS, GRID_MAX_DEPTH, GRID_STEP_SIZE, RAW_TYPES
from .session import get_session
from .sources.files import scan_csv_by_name, scan_features
from .streaming.scoring import ScoringOutputs, run_to_completion
from .streaming.sources import message_stream


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="txnscore")
    sub = p.add_subparsers(dest="cmd", required=True)
    d = sub.add_parser("prepare")
    d.add_argument("--data", required=True)
    d.add_argument("--processed", required=True)
    d.add_argument("--split", default="train")
    t = sub.add_parser("train")
    t.add_argument("--data", required=True)
    t.add_argument("--processed", required=True)
    t.add_argument("--model", required=True)
    t.add_argument("--split", default="train")
    t.add_argument("--grid-parallelism", type=int, default=1)
    t.add_argument("--max-depth", type=int, nargs="+", default=GRID_MAX_DEPTH)
    t.add_argument("--max-bins", type=int, nargs="+", default=GRID_MAX_BINS)
    t.add_argument("--step-size", type=float, nargs="+", default=GRID_STEP_SIZE)
    t.add_argument("--max-iter", type=int, default=20)
    s = sub.add_parser("score")
    s.add_argument("--model", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--path")
    s.add_argument("--servers")
    s.add_argument("--topic", default="transactions")
    s.add_argument("--out-topic")
    s.add_argument("--max-offsets-per-trigger", type=int, default=None)
    s.add_argument("--available-now", action="store_true")
    b = sub.add_parser("publish")
    b.add_argument("--processed", required=True)
    b.add_argument("--path")
    b.add_argument("--servers")
    b.add_argument("--topic", default="transactions")
    a = p.parse_args(argv)

    spark = get_session()
    if a.cmd in ("prepare", "train"):
        txns = scan_csv_by_name(spark, f"{a.data}/{a.split}_transaction.csv", RAW_TYPES)
        ids = scan_csv_by_name(spark, f"{a.data}/{a.split}_identity.csv", RAW_TYPES)
    if a.cmd == "prepare":
        print("built" if api.prepare_split(spark, txns, ids, a.processed) else "already there")
    elif a.cmd == "train":
        grid = [dict(g, max_iter=a.max_iter) for g in param_grid(a.max_depth, a.max_bins, a.step_size)]
        cfg = api.TrainConfig(model_path=a.model, parallelism=a.grid_parallelism, grid=grid)
        _, metrics = api.train(spark, cfg, txns, ids, a.processed)
        metrics.show(truncate=False)
    elif a.cmd == "score":
        source = "kafka" if a.servers else "files"
        messages = message_stream(spark, source, path=a.path, servers=a.servers, topic=a.topic,
                                  max_offsets_per_trigger=a.max_offsets_per_trigger)
        kafka = ({"kafka.bootstrap.servers": a.servers, "topic": a.out_topic} if a.servers and a.out_topic
                 else None)
        outputs = ScoringOutputs(f"{a.out}/scored", f"{a.out}/quarantine", f"{a.out}/kpis", kafka)
        trigger = {"availableNow": True} if a.available_now else None
        run_to_completion(api.score_stream(spark, messages, a.model, outputs, a.checkpoint, trigger=trigger))
    else:
        rows = scan_features(spark, a.processed)
        if a.servers:
            api.publish(rows, "kafka", options={"kafka.bootstrap.servers": a.servers, "topic": a.topic})
        else:
            api.publish(rows, "text", path=a.path)


if __name__ == "__main__":
    main()
