"""Decontamination: what a window is, and which windows count."""

from txnscore.llm.decontam import contaminated

FILLER = "Some other words come first in this document and say nothing of interest at all. "


def pairs(spark, texts, items):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r.doc_id, r.item_id): r for r in contaminated(docs, bench).collect()}


TWO = "The small dog runs over the green hill every morning. What does the small dog see on the other side?"
ALICE = ("Alice has 5 apples and a basket full of ripe pears. Alice gives 2 apples to her best friend at school. "
         "How many apples does Alice have left at the end of the day?")


def test_verbatim_item_is_found_whatever_else_the_text_capitalizes(spark):
    host = 'He said "The end." The Small Dog and What Does it mean, The Green Hill (see What.) On The Other Side. '
    texts = [host + TWO + " " + host, host + TWO.upper(), host + FILLER, "Question " + TWO, TWO.replace(" ", "\n")]
    got = pairs(spark, texts, [TWO])
    assert set(got) == {(0, 0), (1, 0), (3, 0), (4, 0)}
    assert {(r.n_windows, r.n_matched) for r in got.values()} == {(13, 13)}, got


def test_names_that_open_sentences_are_slots(spark):
    other = ALICE.replace("Alice", "Carol").replace("5", "9").replace("2", "3")
    got = pairs(spark, [FILLER + other + " " + FILLER], [ALICE])
    assert set(got) == {(0, 0)} and got[0, 0].n_changed == 3
    assert got[0, 0].n_matched == got[0, 0].n_windows


def test_dense_and_short_items_are_found_inside_documents(spark):
    items = ["12 km 5 m 30 cm 7 mm 9 kg 14 g 3 mg 8 lb 6 oz 11 ml 4 l 2 ft", "Old Man River Meets Big Bad Wolf At Green Lake Near Silver Town",
             "Who wrote the blue book?", "1 1 2 3 5 8", "Xylophone", "How many legs does Anna really have?"]
    texts = [FILLER + i + " " + FILLER for i in items] + [FILLER, "Who wrote the red book? 1 1 2 3 5 9. 12 km 6 m 30 cm"]
    got = pairs(spark, texts, items)
    assert set(got) == {(i, i) for i in range(len(items))}
    # a short item with another name and enough other words
    assert set(pairs(spark, [FILLER + "How many legs does Berta really have? " + FILLER], items)) == {(0, 5)}
    assert set(pairs(spark, ["What is Paris?", FILLER + "What is Paris? " + FILLER], ["What is Rome?"])) == {(0, 0)}


EQUAL = ("The first farm keeps 40 cows in the long barn near the old river and sells fresh milk to the town. "
         "In the second year the same farm still keeps 40 cows but now also sells soft cheese to the village nearby.")


def test_a_conflicting_slot_costs_only_its_own_windows(spark):
    one_edited = EQUAL.replace("keeps 40 cows but", "keeps 41 cows but")
    split = EQUAL.replace("keeps 40 cows in", "keeps 50 cows in").replace("keeps 40 cows but", "keeps 60 cows but")
    got = pairs(spark, [FILLER + one_edited, FILLER + split], [EQUAL])
    assert set(got) == {(0, 0), (1, 0)}
    item = "He paid 7 coins for bread and 7 coins for milk then he walked home alone in rain"
    got = pairs(spark, [FILLER + item.replace("7", "9"), FILLER + item.replace("7", "9", 1).replace("7", "8")], [item])
    assert got[0, 0].n_matched == got[0, 0].n_windows == 11 and got[0, 0].n_changed == 1
    # 7 stands for 9 or for 8: the windows that hold only the more frequent pair count, and the literal ones
    assert (1, 0) in got and got[1, 0].n_matched == 8
