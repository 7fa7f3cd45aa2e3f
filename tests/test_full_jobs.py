"""Registered jobs run whole: the API's sizes, and every query reads its own input."""

import inspect

from conftest import SF_SMALL
from txnscore.operators import models
from txnscore.plans import ml, streams


def test_registered_models_take_the_api_sizes(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(ml, "_encoders", lambda *a: (type("E", (), {"transform": lambda self, x: x})(), None, None))
    monkeypatch.setattr(ml.ml, "grid_search", lambda train, test, grid, make, *a, **k: seen.update(grid=grid, model=make(**grid[0])) or (None, None))
    ml.q_gbt_grid_search(None, SF_SMALL)
    assert len(seen["grid"]) == 18 and seen["model"].getMaxIter() == models.gbt().getMaxIter()
    assert "max_depth" not in inspect.getsource(ml) and "num_trees" not in inspect.getsource(ml)


def test_each_stream_query_runs_its_own_service(spark, monkeypatch):
    runs = []
    start = streams.start_scoring
    monkeypatch.setattr(streams, "start_scoring", lambda *a, **k: runs.append(1) or start(*a, **k))
    n = streams.q_stream_score_sink(spark, SF_SMALL).count()
    kpis = streams.q_stream_batch_kpis(spark, SF_SMALL).collect()
    assert len(runs) == 2 and kpis[0].n == n
