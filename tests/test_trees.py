"""ML2: DuckDB, walking the exported node table, and the Spark expression both score like the fitted models."""

import duckdb
import pytest
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from conftest import SF_SMALL
from txnscore.operators import models, trees
from txnscore.plans.views import ml_events

WALK = """WITH RECURSIVE walk AS (
    SELECT r.event_id, r.x, n.* FROM rows r, nodes n WHERE n.node = 0
    UNION ALL
    SELECT w.event_id, w.x, n.* FROM walk w JOIN nodes n ON n.tree = w.tree AND w."left" >= 0 AND n.node = CASE
      WHEN CASE WHEN w.categories IS NULL THEN w.x[w.feature + 1] <= w.threshold ELSE list_contains(w.categories, w.x[w.feature + 1]) END
      THEN w."left" ELSE w."right" END)
  SELECT event_id, sum(weight * prediction) AS margin, sum(weight * class_counts[2] / list_sum(class_counts)) / sum(weight) AS share
  FROM walk WHERE "left" < 0 GROUP BY 1"""


@pytest.mark.parametrize("kind", ["boosted", "forest"])
def test_sql_over_the_node_table_scores_like_the_model(spark, tmp_path, kind):
    rows = ml_events(spark, SF_SMALL).withColumn("user_bucket", F.concat("user_bucket", F.lit("-"), F.col("event_id") % 4))
    rows = StringIndexer(inputCol="user_bucket", outputCol="u").fit(rows).transform(rows)
    rows = VectorAssembler(inputCols=["value", "k", "u"], outputCol="features").transform(rows)
    est = models.gbt("is_fraud", max_depth=4, max_iter=6) if kind == "boosted" else models.random_forest("is_fraud", num_trees=7, max_depth=6, weight_col=None)
    model = est.fit(rows)
    nodes = trees.node_table(spark, model)
    assert nodes.filter("categories is not null").count() > 0 and nodes.count() == model.totalNumNodes
    nodes.write.parquet(f"{tmp_path}/nodes")
    rows.select("event_id", vector_to_array("features").alias("x")).write.parquet(f"{tmp_path}/rows")
    con = duckdb.connect()
    for t in ("nodes", "rows"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}/*.parquet')")
    sql = {r[0]: r[1:] for r in con.execute(WALK).fetchall()}
    scored = trees.score_with_trees(model.transform(rows).select("event_id", "features", F.col("prediction").alias("p"),
                                                                 vector_to_array("probability")[1].alias("p1")), nodes, model)
    got = scored.collect()
    assert len(got) == len(sql)
    for r in got:
        margin, share = sql[r.event_id]
        assert r.prediction == r.p and abs(r.fraud_probability - r.p1) < 1e-12
        assert (margin > 0 if kind == "boosted" else share > 0.5) == bool(r.p)
        if kind == "forest":
            assert abs(share - r.p1) < 1e-12


def test_forest_by_joins_scores_like_the_model(spark, monkeypatch):
    """Leaves reached through one join per level, broadcast or not; NaN goes right; one tree of one leaf."""
    rows = ml_events(spark, SF_SMALL).withColumn("value", F.when(F.col("event_id") % 9 == 0, float("nan")).otherwise(F.col("value")))
    rows = StringIndexer(inputCol="user_bucket", outputCol="u").fit(rows).transform(rows)
    rows = VectorAssembler(inputCols=["value", "k", "u"], outputCol="features", handleInvalid="keep").transform(rows)
    clean = rows.filter("not isnan(value)")
    model = models.random_forest("is_fraud", num_trees=5, max_depth=5, weight_col=None).fit(clean)
    nodes = trees.node_table(spark, model)
    want = {r.event_id: r.p for r in model.transform(rows).select("event_id", vector_to_array("probability")[1].alias("p")).collect()}
    for limit in (trees.BROADCAST_NODES, 0):
        monkeypatch.setattr(trees, "BROADCAST_NODES", limit)
        leaves = trees.leaves_by_joins(rows, nodes, model, "event_id")
        assert leaves.count() == 5 * len(want)
        got = {r.event_id: r.fraud_probability for r in trees.forest_probability(leaves, "event_id").collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)
    stump = models.random_forest("is_fraud", num_trees=1, max_depth=0, weight_col=None).fit(clean)
    leaves = trees.leaves_by_joins(rows, trees.node_table(spark, stump), stump, "event_id")
    assert leaves.count() == len(want)
    assert trees.leaves_by_joins(rows.limit(0), nodes, model, "event_id").count() == 0
