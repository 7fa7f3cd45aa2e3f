"""Counter rates with resets, gaps and single samples; in-flight gauge; category lookup of constant plan size."""

from datetime import datetime, timedelta

from txnscore.operators import series
from txnscore.streaming.scoring import with_category_reason
from pyspark.sql import functions as F

T0 = datetime(2024, 1, 1, 0, 4, 30)


def at(s):
    return T0 + timedelta(seconds=s)


def test_counter_rate_over_resets_gaps_and_stretches(spark):
    a = [(0, 5), (60, 9), (100, 2), (130, 4), (399, 10), (400, 11), (5000, 3), (5299, 1), (5300, 7)]
    rows = [("a", at(s), v) for s, v in a] + [("b", at(7), 1), ("b", None, 3), ("b", at(9), None)]
    out = series.counter_rate(spark.createDataFrame(rows, "s string, ts timestamp_ntz, v long"), ["s"], "ts", "v", 300)
    got = {(r.s, int((r.ts - T0).total_seconds())): (r.n_samples, r.increase, r.rate) for r in out.collect()}
    want = {}
    for s, v in a:
        inside = [(x, y) for x, y in a if s - 300 < x <= s]
        inc = sum(q - p if q >= p else q for (_, p), (_, q) in zip(inside, inside[1:]))
        want["a", s] = (len(inside), inc if len(inside) > 1 else None, inc / 300 if len(inside) > 1 else None)
    want["b", 7] = (1, None, None)
    assert got == want
    assert got["a", 100][1] == 4 + 2 and got["a", 5000] == (1, None, None)


def test_in_flight_over_overlapping_batches(spark):
    rows = [("p", at(0), at(10), 5), ("q", at(3), at(5), 2), ("p", at(10), at(12), 4), ("q", at(11), None, 1), ("q", None, at(1), 9)]
    out = series.in_flight(spark.createDataFrame(rows, "query string, batch_start timestamp_ntz, batch_end timestamp_ntz, n long"))
    got = [(int((r.instant - T0).total_seconds()), r.delta, r.in_flight) for r in out.orderBy("instant").collect()]
    assert got == [(0, 5, 5), (3, 2, 7), (5, -2, 5), (10, -1, 4), (11, 1, 5), (12, -4, 1)]


def test_category_lookup_does_not_grow_the_plan(spark):
    rows = spark.createDataFrame([("l7",), ("l99999",), ("new",), (None,)], "c string")
    sizes = {}
    for n in (10, 100_000):
        out = with_category_reason(rows, F.lit(None).cast("string"), {"c": [f"l{k}" for k in range(n)]})
        sizes[n] = len(out._jdf.queryExecution().toString())
        got = {r.c: r.reason for r in out.collect()}
    assert got == {"l7": None, "l99999": None, "new": "unknown_c", None: "unknown_c"}
    assert sizes[100_000] < 1.2 * sizes[10] and out.columns == ["c", "reason"]
