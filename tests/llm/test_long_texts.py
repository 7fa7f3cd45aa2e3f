"""Very long texts, lines and urls, and one very frequent line: nothing is cut and nothing is lost."""

import random

import pytest

import corpus_pipeline as cp
from conftest import SF_SMALL
from llm import brute
from txnscore.llm import url_filter
from txnscore.llm.decontam import contaminated
from txnscore.llm.line_dedup import dedup_lines
from txnscore.llm.mixing import mix
from txnscore.llm.tables import table

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int) -> str:
    """``n`` lines of 12 random words, each a sentence."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 9)))
    return "\n".join(" ".join(word() for _ in range(12)).capitalize() + "." for _ in range(n))


@pytest.fixture(scope="module")
def long_text():
    return prose(1, 25_000)


def test_mix_counts_the_whole_text(spark, long_text):
    one_line = long_text.replace("\n", " ")
    df = spark.createDataFrame([(1, long_text, "a"), (2, one_line, "b"), (3, "w w", "b")], "doc_id long, text string, source string")
    got = {r.doc_id: r["size"] for r in mix(df).collect()}
    assert got == {1: 300_000, 2: 300_000, 3: 2}


def test_an_item_at_the_end_of_a_long_text_is_found(spark, long_text):
    item = prose(2, 5).replace("\n", " ")
    rows = [(1, f"{long_text} {item}"), (2, long_text), (3, long_text.replace("\n", " ") + " " + item)]
    got = contaminated(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(7, item)], "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == {(1, 7), (3, 7)}


def test_long_urls_keep_host_and_path(spark):
    path, label = "/es/" + "seite-7/" * 50_000, "a" * 20_000
    rows = [(1, f"https://example.org{path}?q=1"), (2, f"https://{label}.com/fr/1"), (3, "https://e.net/#" + "x" * 400_000)]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(
        spark.createDataFrame(rows, "page_id long, url string"),
        [("allow", "org/"), ("block", "example.org/es/"), ("allow", "com/fr/")]).collect()}
    assert got[1] == ("example.org", path, "example.org/es/", "block")
    assert got[2] == (f"{label}.com", "/fr/1", "com/fr/", "allow")
    assert got[3][:3] == ("e.net", "/", None)


def test_one_line_in_every_document_stays_once(spark):
    hot = "All rights to this text are held by the people who wrote it down first."
    rows = [(k, f"{prose(100 + k, 1)}\n{hot}\n{prose(5000 + k, 1)}") for k in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(16)
    got = {r.doc_id: (r.text, r["__n_removed"]) for r in dedup_lines(df).collect()}
    assert got[0] == (rows[0][1], 0)
    assert all(got[k] == (rows[k][1].replace(f"\n{hot}", ""), 1) for k in range(1, 600))


@pytest.mark.parametrize("k", range(5))
def test_every_stage_keeps_a_long_text_whole(spark, long_text, k):
    data = [(1, long_text, "en", "s", len(long_text)), (2, prose(3, 4), "en", "s", 300), (3, prose(4, 4), "de", "t", 300)]
    docs = spark.createDataFrame(data, DOCS)
    if k == 3:
        item = table(spark, SF_SMALL, "benchmark").filter("length(text) > 100").orderBy("item_id").first().text
        docs = docs.union(spark.createDataFrame([(4, f"{long_text}\n{item}", "en", "s", 1)], DOCS))
    got = {r.doc_id: r.text for r in cp.STAGES[k][1](spark, docs, SF_SMALL).collect()}
    if k == 4:
        # the mix may leave a document out, but takes it whole
        assert got and all(got[i] == t for i, t, *_ in data if i in got)
    else:
        assert got == {i: t for i, t, *_ in data}
    assert len(brute.words(long_text)) == 300_000
