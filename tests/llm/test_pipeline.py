"""The pipeline's stages against brute-force versions, and their edge cases."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from conftest import SF_SMALL
from llm import brute
from oracle_check import duck
from txnscore.llm.line_dedup import FAMILIES
from txnscore.llm.quality_rules import ORACLE_SQL
from txnscore.llm.tables import table


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_equal_brute_force(spark, tmp_path):
    docs = table(spark, SF_SMALL, "documents")
    columns = docs.columns

    def step(k, df):
        name, stage = cp.STAGES[k]
        out = stage(spark, df, SF_SMALL)
        if k < len(cp.STAGES) - 1:
            assert out.columns == columns
        out.write.parquet(str(tmp_path / f"{k}"))
        return spark.read.parquet(str(tmp_path / f"{k}"))

    first = step(0, docs)
    con = duck(SF_SMALL)
    assert set(rows(first)) == {r[0] for r in con.execute(f"SELECT doc_id FROM ({ORACLE_SQL}) WHERE kept").fetchall()}
    before = {i: r.text for i, r in rows(first).items()}
    second = step(1, first)
    want = {i: t for i, t in brute.dedup_lines(before, FAMILIES, 80).items() if t == before[i] or brute.words(t)}
    assert {i: r.text for i, r in rows(second).items()} == want
    assert all(r.n_chars == len(r.text) for r in rows(second).values())
    third = step(2, second)
    component = brute.near_duplicates(want, 5, 80)
    assert set(rows(third)) == {i for i, (_, c) in component.items() if c == i}
    fourth = step(3, third)
    bench = [" ".join(brute.words(brute.lower(r.text))) for r in table(spark, SF_SMALL, "benchmark").collect()]
    holds = {i for i, r in rows(third).items() if any(b in " ".join(brute.words(brute.lower(r.text))) for b in bench)}
    assert not holds & set(rows(fourth))
    fifth = step(4, fourth)
    kept = rows(fourth)
    size = {i: len(brute.words(r.text)) for i, r in kept.items()}
    by_source = {}
    for i, r in kept.items():
        by_source[r.source] = by_source.get(r.source, 0) + size[i]
    target = brute.targets(by_source)
    out = rows(fifth)
    for source, wanted in target.items():
        taken = [r.taken for r in out.values() if r.source == source]
        assert abs(sum(taken) - wanted) <= max(size.values())
    assert all(r.taken == r.copies * size[i] and r.copies >= 1 for i, r in out.items())


def test_run_equals_the_registered_query(spark):
    from txnscore.llm.queries import queries
    got, again = rows(cp.run(spark, SF_SMALL)), rows(queries()["pipeline"](spark, SF_SMALL))
    assert got and {i: (r.text, r.taken) for i, r in got.items()} == {i: (r.text, r.taken) for i, r in again.items()}


@pytest.mark.parametrize("k", range(5))
def test_stages_keep_odd_rows_and_columns(spark, k):
    good = "This sentence has more than ten words and it ends as it should here."
    data = [(1, f"{good} One.", "en", "s", 5, "a"), (1, f"{good} One.", "en", "s", 5, "a"), (None, f"Nothing else is like this one line of plain words at all, {good}", None, None, None, "b"),
            (3, None, "en", "s", None, "c"), (4, "", None, None, 0, "d"), (5, "  \n ", "en", "t", 3, "e")]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, size string")
    name, stage = cp.STAGES[k]
    out = stage(spark, docs, SF_SMALL)
    got = out.collect()
    if k < 4:
        assert out.columns == docs.columns
    else:
        assert set(docs.columns) <= set(out.columns)
    ids = [r.doc_id for r in got]
    assert 1 in ids and None in ids
    if k in (1, 2, 3):
        assert {3, 4, 5} <= set(ids)
    assert stage(spark, docs.limit(0), SF_SMALL).count() == 0
