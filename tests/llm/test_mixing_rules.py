"""Mixing, quality rules and decontamination."""

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF_CHECK, SF_SMALL
from llm import brute
from oracle_check import compare, duck
from txnscore.llm.decontam import contaminated, drop_contaminated
from txnscore.llm.mixing import mix
from txnscore.llm.quality_rules import ORACLE_SQL, assess, keep_clean, quality_rules
from txnscore.llm.queries import queries


def test_mix_targets_and_bounds(spark):
    got = queries()["op3_weighted_mix"](spark, SF_CHECK).toPandas()
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").toPandas()
    assert sorted(got.doc_id) == sorted(docs.doc_id)
    size = {i: len(brute.words(t)) for i, t in zip(docs.doc_id, docs.text)}
    assert dict(zip(got.doc_id, got["size"])) == size
    by_source = docs.assign(size=[size[i] for i in docs.doc_id]).groupby("source")["size"].sum().to_dict()
    want = brute.targets(by_source)
    longest = max(size.values())
    for source, rows in got.groupby("source"):
        assert rows.target.iloc[0] == pytest.approx(want[source])
        assert abs(rows.taken.sum() - want[source]) <= longest
        assert set(rows.source_size) == {by_source[source]}
    assert (got.taken <= 3 * got["size"]).all()
    again = queries()["op3_weighted_mix"](spark, SF_CHECK).toPandas()
    assert dict(zip(again.doc_id, again.taken)) == dict(zip(got.doc_id, got.taken))


def test_mix_caps_nulls_and_empty_sources(spark):
    rows = [(i, "w " * 10, "a") for i in range(30)] + [(100 + i, "w " * 10, "b") for i in range(2)] + [
        (200, "", "c"), (201, None, "c"), (300, "w w", None), (None, "w w w", None), (400, "w", "d"), (400, "w", "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("x")).withColumn("rank", F.lit(1))
    got = mix(df).toPandas()
    assert len(got) == len(rows)
    sizes = {"a": 300, "b": 20, "c": 0, "d": 2, None: 5}
    want = brute.targets(sizes)
    for source, n in sizes.items():
        rows_of = got[got.source.isna()] if source is None else got[got.source == source]
        assert rows_of.target.iloc[0] == pytest.approx(want[source])
        assert abs(rows_of.taken.sum() - want[source]) <= 10
    assert mix(df.limit(0)).count() == 0
    assert mix(df.filter("source = 'c'")).toPandas().taken.sum() == 0


def test_quality_rules_equal_sql(spark):
    for sf in (SF_SMALL, SF_CHECK):
        assert compare(queries()["op4_quality_rules"](spark, sf), ORACLE_SQL, duck(sf)) == []


def test_quality_rules_lines(spark):
    good = "This is a plain sentence that has enough words to be kept here."
    cases = {"clean": (good, good), "menu": (f"Home Menu Login\n{good}", good), "table": (f"a | b | c | d.\n{good}", good),
             "notice": (f"We use cookies on this site.\n{good}", good), "shout": (f"BUY IT NOW TODAY.\n{good}", good),
             "runs": (f"so!! many!! marks!!\n{good}", good), "no end": (f"A title without end\n{good}", good),
             "blank": (f"\n \n{good}\n", f"\n \n{good}\n"), "tabs": (f"\t{good}\r\nIt\tends here.", f"\t{good}\r\nIt\tends here."),
             "null": (None, None), "empty": ("", None)}
    rows = spark.createDataFrame([(k, t) for k, (t, _) in cases.items()], "doc_id string, text string")
    got = {r.doc_id: r for r in assess(rows).collect()}
    for k, (text, clean) in cases.items():
        assert got[k]["__kept"] == (k not in ("null", "empty")), k
        if got[k]["__kept"]:
            assert got[k]["__clean"] == clean, k
    junk = spark.createDataFrame([("x", "a | b | c | d | e | f\n" * 5 + good, 1)], "doc_id string, text string, n_words int")
    row = assess(junk).first()
    assert not row["__kept"] and row["n_words"] == 1
    kept = keep_clean(rows.withColumn("n_chars", F.lit(0).cast("long")))
    assert kept.columns == ["doc_id", "text", "n_chars"]
    assert all(r.n_chars == len(r.text) for r in kept.collect())
    assert quality_rules(rows.limit(0)).count() == 0


SCRIPTS = {  # sentences of ten words or more, each with the sentence mark of its script
    "hindi": "यह एक साधारण वाक्य है जिसमें बहुत से शब्द हैं और जो पूरी तरह समाप्त होता है।",
    "urdu": "یہ ایک سادہ جملہ ہے جس میں بہت سے الفاظ ہیں اور یہ مکمل ہے۔",
    "arabic": "هل هذه جملة بسيطة فيها كلمات كثيرة تكفي لكي تبقى في النص؟",
    "armenian": "Սա մի պարզ նախադասություն է որը ունի բավական շատ բառեր որպեսզի մնա այստեղ։",
    "amharic": "ይህ ብዙ ቃላት ያሉት ቀላል ዓረፍተ ነገር ነው እና እዚህ መቆየት አለበት።",
    "chinese": "一 二 三 四 五 六 七 八 九 十 这是一个句子。",
    "thai": "นี่ คือ ประโยค ธรรมดา ที่ มี คำ มาก พอ จะ อยู่ ที่ นี่"}


def test_quality_rules_of_other_scripts(spark):
    """Sentences of any script stay, and a line of the script without its mark goes (Thai has no mark); equal to the SQL."""
    rows = [(k, t, True) for k, t in SCRIPTS.items()]
    rows += [(f"{k} open", t[:-1], False) for k, t in SCRIPTS.items() if k != "thai"]
    rows += [(f"{k} notice", f"{t}\nprivacy policy {' '.join('abcdefghijkl')}", False) for k, t in SCRIPTS.items()]
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id string, text string")
    got = {r.doc_id: r.kept for r in quality_rules(df).collect()}
    assert {k: got[k] for k, _, want in rows if got[k] != want and "notice" not in k} == {}
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    assert compare(quality_rules(df), ORACLE_SQL, con) == []


def test_repeated_windows_by_brute_force(spark):
    texts = ["a b c d e f a b c d e", "x " * 40, "a b c d", "p q r s t u v p q r s t w p q r s t", " ".join(map(str, range(3000))) + " 5 6 7 8 9 10", "a  b\tc\nd e a b c d e"]

    def repeated(text):
        w = brute.words(text)
        seen = {}
        for i in range(len(w) - 4):
            seen.setdefault(tuple(w[i:i + 5]), []).append(i)
        return len({i + k for at in seen.values() if len(at) > 1 for i in at for k in range(5)})

    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.n_repeat_words for r in quality_rules(df).collect()} == {i: repeated(t) for i, t in enumerate(texts)}


def test_mix_of_null_and_text_ids_and_differing_rows(spark):
    from txnscore.llm.mixing import mix, mixed
    rows = [(None, "a b c d", "s"), (None, "a b c d e f g h", "s"), (None, "a", "s"), ("x", "one two", "t"), ("x", "one two three", "t"),
            ("y", "one", None), ("y", "one", None), ("z", None, "t")]
    docs = spark.createDataFrame(rows, "doc_id string, text string, source string")
    got = sorted((str(r.doc_id), str(r.source), r["size"]) for r in mix(docs).collect())
    assert got == sorted((str(i), str(s), len((t or "").split())) for i, t, s in rows)
    out = mixed(docs).collect()
    assert all(r["size"] == len(r.text.split()) and r.taken == r.copies * r["size"] for r in out)
    assert sum(r.taken for r in out) <= sum(len((t or "").split()) for _, t, _ in rows)
    assert len([r for r in out if r.doc_id == "y"]) in (0, 2)


ITEM = ("A train leaves the station with 120 passengers and travels for 3 hours at a speed of 80 km per hour towards Berlin. "
        "How far does the train go before it reaches the city of Berlin in the end?")
FILLER = "Some other words come first in this document and say nothing of interest at all. "


def decontaminate(spark, texts, items=(ITEM,)):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {r.doc_id: r for r in contaminated(docs, bench).collect()}


def test_decontamination_cases(spark):
    other = ITEM.replace("120", "75").replace("80", "95").replace("Berlin", "Madrid")
    # no 13 words in a row are the item's; with one name for Berlin the windows that remain are just enough
    part = ITEM.replace("120", "many").replace(" 3 ", " some ").replace("80", "great").replace("before", "until")
    mixed, renamed = part.replace("towards Berlin", "towards Madrid").replace("of Berlin", "of Paris"), part.replace("Berlin", "Madrid")
    texts = [FILLER + ITEM + " More text.", FILLER + other, ITEM.lower(), FILLER * 3, ITEM.replace(" ", "\n  "), "", None,
             ITEM[:100] + FILLER, FILLER + ITEM[:52], ITEM + ITEM, mixed, renamed]
    got = decontaminate(spark, texts)
    assert {0, 1, 2, 4, 7, 9, 11} <= set(got) and not {3, 5, 6, 8} & set(got)
    assert got[0].n_changed == 0 and got[1].n_changed == 3
    assert got[0].n_literal == got[0].n_windows and not got[0].weak and got[1].by_template and got[1].n_literal < got[0].n_literal
    # Berlin stands for both Madrid and Paris along one distance: no re-parameterised copy
    assert 10 not in got


def test_an_item_of_few_words_removes_nothing(spark):
    docs = spark.createDataFrame([(k, f"{FILLER} music {k}") for k in range(4)] + [(9, FILLER + ITEM)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "music"), (2, ITEM)], "item_id long, text string")
    assert {r.doc_id for r in contaminated(docs, bench).collect() if r.weak} == {0, 1, 2, 3}
    assert sorted(r.doc_id for r in drop_contaminated(docs, bench).collect()) == [0, 1, 2, 3]


def test_decontamination_edges(spark):
    docs = spark.createDataFrame([(1, ITEM, "a"), (1, ITEM, "b"), (None, ITEM, "c"), (2, FILLER, "d"), (3, None, "e")], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(5, ITEM, "q"), (5, ITEM, "q"), (6, None, "q"), (None, ITEM, "q"), (7, "", "q"), (8, "Short one.", "q")],
                                  "item_id long, text string, doc_id string")
    assert [(r.doc_id, r.item_id) for r in contaminated(docs, bench).collect()] == [(1, 5)]
    left = drop_contaminated(docs, bench)
    assert left.columns == docs.columns and sorted(r.item_id for r in left.collect()) == ["c", "d", "e"]
    assert contaminated(docs, bench.limit(0)).count() == 0 and contaminated(docs.limit(0), bench).count() == 0


def test_registered_decontamination_finds_whole_items(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").collect()
    bench = spark.read.parquet(f"{SF_CHECK}/benchmark.parquet").collect()
    flat = {r.item_id: " ".join(brute.words(brute.lower(r.text))) for r in bench}
    want = {(d.doc_id, i) for d in docs for i, t in flat.items() if t in " ".join(brute.words(brute.lower(d.text or "")))}
    got = {(r.doc_id, r.item_id) for r in queries()["op10_decontam"](spark, SF_CHECK).collect()}
    assert want and want <= got
    assert len(got - want) <= len(want) // 4
