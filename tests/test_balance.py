"""Training and scoring tasks are bounded by rows, the walk by joins by its code, a bounded stream's batches by bytes."""

import contextlib
import io
import re

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Observation
from pyspark.sql import functions as F

from conftest import SF_SMALL
from txnscore.operators import models, trees
from txnscore.plans import streams
from txnscore.plans.views import ml_events
from txnscore.streaming.scoring import read_kpis


def _small_tasks(monkeypatch):
    for name, n in (("ROWS_PER_TASK", 50), ("TASKS_AT_LEAST", 4), ("ROWS_UNSPLIT", 100)):
        monkeypatch.setattr(models, name, n)


def _placed(df):
    return df.rdd.glom().collect()


def test_training_rows_are_spread_over_tasks_whatever_their_files(spark, monkeypatch):
    _small_tasks(monkeypatch)
    rows = ml_events(spark, SF_SMALL)
    tasks = _placed(models.balanced(rows.coalesce(1), ordered=True))
    assert max(map(len, tasks)) <= 2 * 50 and sorted(r for t in tasks for r in t) == sorted(rows.collect())
    assert tasks == _placed(models.balanced(rows.repartition(7), ordered=True))
    assert max(map(len, _placed(models.balanced(rows.coalesce(1))))) <= 2 * 50
    few = rows.filter("event_id < 50").coalesce(1)
    assert models.balanced(few) is few


def test_fit_gets_small_tasks(spark, monkeypatch):
    _small_tasks(monkeypatch)
    seen = []

    class Estimator:
        def __init__(self, **_):
            pass

        def hasParam(self, _):
            return False

        def fit(self, data):
            seen.append(data.rdd.getNumPartitions())
            raise InterruptedError

    rows = VectorAssembler(inputCols=["value", "k"], outputCol="features").transform(ml_events(spark, SF_SMALL).coalesce(1))
    for run in (lambda: models.fit_persisted(Estimator(), rows), lambda: models.grid_search(rows, rows, [{}], Estimator)):
        with contextlib.suppress(InterruptedError):
            run()
    assert len(seen) == 2 and min(seen) >= 1000 // 50


def test_walk_by_joins_stays_within_what_the_jvm_compiles(spark):
    rows = VectorAssembler(inputCols=["value", "k"], outputCol="features").transform(ml_events(spark, SF_SMALL))
    model = models.random_forest("is_fraud", num_trees=2, weight_col=None).fit(rows)
    assert max(t.depth for t in model.trees) > 9
    leaves, out = trees.leaves_by_joins(rows, trees.node_table(spark, model), model, "event_id"), io.StringIO()
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the final plan holds the code
    try:
        with contextlib.redirect_stdout(out):
            leaves.select(F.hash(*leaves.columns)).explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", out.getvalue())]
    assert sizes and max(sizes) < 8000


def test_micro_batches_do_not_grow_with_the_files(spark, monkeypatch):
    monkeypatch.setattr(streams, "RECORDS_PER_FILE", 20)
    outputs = streams._score_stream(spark, SF_SMALL)
    kpis = read_kpis(spark, outputs.kpis)
    assert 2 <= kpis.count() <= 3
    assert kpis.agg(F.sum("n") + F.sum("n_quarantined")).first()[0] == 1000


def test_a_new_forest_scores_in_a_session_that_observed(spark):
    seen = Observation()
    rows = VectorAssembler(inputCols=["value", "k"], outputCol="features").transform(ml_events(spark, SF_SMALL))
    rows.observe(seen, F.count(F.lit(1)).alias("n")).collect()
    model = models.random_forest("is_fraud", num_trees=2, max_depth=2, weight_col=None).fit(rows)
    assert model.transform(rows).filter("prediction is not null").count() == seen.get["n"]
