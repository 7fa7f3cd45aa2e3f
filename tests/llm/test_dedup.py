"""Near-dedup, line dedup and union-find against brute force, and their edge cases."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_CHECK, SF_SMALL
from llm import brute
from txnscore.llm import near_dup
from txnscore.llm.graph import components
from txnscore.llm.line_dedup import FAMILIES, dedup_lines

SCHEMA = "doc_id long, text string, id string, key string, n string"


def corpus(seed=3):
    """Random documents, near copies of several grades, copies, shared passages, odd texts."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    sentence = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n)).capitalize() + "."
    passage = "\n".join(sentence(30) for _ in range(2))
    texts, doc = {}, 0
    for _ in range(12):
        base = [sentence(rng.randint(8, 25)) for _ in range(rng.randint(2, 8))]
        if rng.random() < 0.5:
            base.insert(1, passage)
        for grade in (0, 0, 1, 2, 4, 8):
            lines = "\n".join(base).split(" ")
            for _ in range(grade):
                lines[rng.randrange(len(lines))] = rng.choice(vocabulary)
            texts[doc] = " ".join(lines)
            doc += rng.randint(1, 3)
    for odd in ("", "   \n\t", "one", "one", "One  two", "é" * 50, "word " * 3000, "\n".join(["again and again."] * 40), None):
        texts[doc] = odd
        doc += 1
    return texts


def frame(spark, texts):
    return spark.createDataFrame([(d, t, "x", "y", None) for d, t in texts.items()], SCHEMA).repartition(4)


@pytest.mark.parametrize("size, percent, half", [(3, 85, 3), (5, 80, 2)])
def test_near_duplicates_equal_brute_force(spark, size, percent, half):
    texts = corpus()
    got = near_dup.near_duplicates(frame(spark, texts), size, percent, half).collect()
    want = brute.near_duplicates(texts, size, percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_registered_near_dup_equals_brute_force(spark):
    from txnscore.llm.queries import queries
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").collect()}
    got = queries()["op6_near_dup"](spark, SF_CHECK).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.near_duplicates(texts, 3, 85)


def test_near_group_that_is_no_clique(spark):
    """A chain of edits: neighbours link, the ends do not, and one component results."""
    words = [f"w{i}" for i in range(60)]
    texts = {}
    for k in range(20):
        words[k * 3] = f"changed{k}"
        texts[100 - k] = " ".join(words)
    texts[5] = " ".join(f"other{i}" for i in range(60))
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(frame(spark, texts), 3, 85, 3).collect()}
    assert got == {d: c for d, (_, c) in brute.near_duplicates(texts, 3, 85).items()}
    assert got[100] == 81


def test_near_duplicates_null_ids_and_repeated_rows(spark):
    rows = [(None, "a b c d e f", None, None, None), (None, "a b c d e f", None, None, None), (7, "a b c d e f", None, None, None),
            (7, "a b c d e f", None, None, None), (9, "A b c d e F", None, None, None), (10, None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = near_dup.near_duplicates(df).collect()
    assert sorted((str(r.doc_id), str(r.component_id), r.kept) for r in got) == [
        ("10", "10", True), ("7", "7", True), ("7", "7", True), ("9", "7", False), ("None", "None", True), ("None", "None", True)]
    left = near_dup.drop_near_duplicates(df)
    assert left.columns == df.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == ["10", "7", "None", "None"]
    assert near_dup.near_duplicates(df.limit(0)).count() == 0


def test_differing_rows_of_one_id_keep_the_same_row_every_time(spark):
    rows = [(7, f"text number {k} of the one id that has several rows", "i", "k", "n") for k in range(4)]
    left = {near_dup.drop_near_duplicates(spark.createDataFrame(r, SCHEMA).repartition(n)).first().text
            for r, n in ((rows, 1), (rows[::-1], 3))}
    assert len(left) == 1


def test_lines_equal_brute_force(spark):
    texts = corpus()
    docs = frame(spark, texts).drop("id", "key", "n")
    plain = ((8, 0, 1 << 40),)
    assert {r.doc_id: r.text for r in dedup_lines(docs, plain).collect()} == brute.dedup_lines(texts, plain, 80)
    got = dedup_lines(docs).collect()
    want = brute.dedup_lines(texts, FAMILIES, 80)
    assert {r.doc_id: r.text for r in got} == want
    for r in got:
        lines = [x for x in (texts[r.doc_id] or "").split("\n") if brute.words(x)]
        assert r["__n_lines"] == len(lines)
        assert r["__n_removed"] == len(lines) - len([x for x in (r.text or "").split("\n") if brute.words(x)])


def test_registered_line_dedup_equals_brute_force(spark):
    from txnscore.llm.queries import queries
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = queries()["op5_line_dedup"](spark, SF_SMALL).collect()
    assert {r.doc_id: r.text for r in got} == brute.dedup_lines(texts, FAMILIES, 80)


def test_lines_null_ids_repeats_and_clashing_columns(spark):
    rows = [(None, "Same line here.", "i", "k", "n"), (3, "Same line here.\n\nOwn text of three.", "i", "k", "n"),
            (3, "Same line here.\n\nOwn text of three.", "i", "k", "n"), (4, "same  LINE here.\nFour.", "i", "k", "n"), (5, None, "i", "k", "n"), (6, "", "i", "k", "n")]
    df = spark.createDataFrame(rows, SCHEMA)
    out = dedup_lines(df)
    assert out.columns == [*df.columns, "__n_lines", "__n_removed"]
    got = sorted((str(r.doc_id), str(r.text), r.key) for r in out.collect())
    assert got == [("3", "Same line here.\n\nOwn text of three.", "k"), ("3", "Same line here.\n\nOwn text of three.", "k"),
                   ("4", "Four.", "k"), ("5", "None", "k"), ("6", "", "k"), ("None", "Same line here.", "k")]
    assert dedup_lines(df.limit(0)).count() == 0


def test_rows_of_one_id_with_different_texts_keep_their_own_lines(spark):
    rows = [(1, "Shared opening line.\nOnly in document one."), (2, "Shared opening line.\nSecond of two."), (2, "Occurs nowhere else.\nSecond of two."),
            (2, "Occurs nowhere else.\nSecond of two.")]
    got = sorted(r.text for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert "Shared opening line.\nOnly in document one." in got
    left = sorted(x for t in got for x in t.split("\n"))
    # the two equal rows are one document, the third row another one: one copy of "Second of two." stays
    assert left.count("Occurs nowhere else.") == 2 and left.count("Shared opening line.") == 1
    assert len({t for t in got if "Second of two." in t}) == 1


def test_short_lines_with_one_edit_link(spark):
    day = "Published by the editorial staff on the {} day of this month."
    docs = spark.createDataFrame([(k, day.format(10 + k) + f"\n{'abcdefgh'[k] * 30} own") for k in range(5)], "doc_id long, text string")
    assert sum(r.text.startswith("Published") for r in dedup_lines(docs).collect()) == 1


def test_hot_lines_and_many_shards(spark, monkeypatch):
    from txnscore.llm import line_dedup
    monkeypatch.setattr(line_dedup, "SHARD", 50)
    monkeypatch.setattr(line_dedup, "MANY_USES", 20)
    monkeypatch.setattr(line_dedup, "FEW", 3)
    texts = corpus(5) | {5000 + k: f"One line that a third of all documents hold.\nNumber {'xyz'[k % 3] * (20 + k)}" for k in range(60)}
    docs = frame(spark, texts).repartition(7)
    assert {r.doc_id: r.text for r in dedup_lines(docs).collect()} == brute.dedup_lines(texts, FAMILIES, 80)


def test_components_of_random_graphs(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, i) for i in range(200, 260)] + [
        (rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(70)] + [(5, 5), (61, 0)]
    got = components(spark.createDataFrame(edges, "a long, b long"))
    nodes = {x for a, b in edges for x in (a, b) if a != b}
    want = brute.union_find(nodes | {5}, edges)
    assert {r.node: r.component for r in got.collect()} == {n: want[n] for n in nodes}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_minhash_agreement_estimates_similarity():
    import numpy as np
    from txnscore.llm import textbytes as tb
    rng = np.random.RandomState(0)
    a, b = rng.randint(0, 1 << 62, (2, 300)).astype(np.uint64)
    mixed = np.concatenate([np.sort(a), np.sort(np.concatenate([a[:200], b[:100]]))])
    sig = near_dup.minhashes(mixed, np.array([0, 300, 600]), 2000)
    assert abs((sig[0] == sig[1]).mean() - 0.5) < 0.05
    assert tb.group_reduce(np.add, np.ones(3), np.array([0, 0, 3]), 0).tolist() == [0, 3]


def test_word_spans_match_the_regular_expression(spark):
    import pyarrow as pa
    from txnscore.llm import textbytes as tb
    texts = ["a b", "", None, " x\ty\n", "é ü\x0bz", "a b c", "x" * 2_000_000, "end"]
    got = {}
    for s in tb.slices(pa.array(texts)):
        start, end, doc = tb.words(s)
        raw = s.buf.tobytes()
        for x, y, d in zip(start, end, doc):
            got.setdefault(int(d) + s.first, []).append(raw[x:y].decode())
    assert got == {i: brute.words(t) for i, t in enumerate(texts) if brute.words(t)}


def _near_copies(n):
    """One line in ``n`` copies of one to four new words each, and unlike lines."""
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(60)]
    texts = {}
    for k in range(n):
        copy = list(words)
        for _ in range(1 + k % 4):
            copy[rng.randrange(60)] = "".join(rng.choice("klmnopqrst") for _ in range(6))
        texts[k] = " ".join(copy) + "\n" + " ".join("".join(rng.choice("uvwxyz") for _ in range(6)) for _ in range(20))
    return texts


def test_pairs_of_a_group_of_near_copies_grow_with_its_lines(spark, monkeypatch):
    from txnscore.llm import line_dedup
    formed, verified = [], line_dedup.verified_lines

    def counted(pairs, *rest):
        formed.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(line_dedup, "verified_lines", counted)
    texts = _near_copies(400)
    docs = frame(spark, texts).select("doc_id", "text")
    got = {r.doc_id: r.text for r in dedup_lines(docs).collect()}
    assert got == brute.dedup_lines(texts, FAMILIES, 80)
    # 12 bands: every line meets the heads of its buckets, and few others
    assert sum(formed) <= 16 * 400, formed


def test_maps_never_reject_linked_lines(spark):
    from txnscore.llm.line_dedup import _possible, line_maps
    lines = [(8, k, t.split("\n")[0]) for k, t in _near_copies(60).items()]
    maps = line_maps(spark.createDataFrame([(1, k, x) for _, k, x in lines], "family long, id long, line string"), FAMILIES)
    side = lambda c: maps.select(*[F.col(x).alias(f"{c}_{x}") for x in ("id", "n", "bits")])
    met = {(r.a_id, r.b_id) for r in side("a").crossJoin(side("b")).filter(_possible("a", "b", 80)).select("a_id", "b_id").collect()}
    sets = {k: {x[i:i + 8] for i in range(len(x) - 7)} for _, k, x in lines}
    linked = {(a, b) for a in sets for b in sets if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert linked <= met and len(linked) < len(met) < len(sets) ** 2
