"""op13 against modified Kneser-Ney in plain Python at orders 2 and 3; the model sums to one; odd rows."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from oracle_check import compare, duck

from conftest import SF_SMALL
from txnscore.llm import kneser_ney, mapped, textbytes
from txnscore.llm.queries import op13_lm_score
from txnscore.sources.tables import read_table

END, START = object(), object()


def tokens(text):
    return [w.lower() if w.isascii() else "".join(c.lower() if c.isascii() else c for c in w)
            for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")] + [END]


def discounts(counts):
    n = [sum(c == k for c in counts.values()) for k in (1, 2, 3, 4)]
    if min(n) > 0:
        y = n[0] / (n[0] + 2 * n[1])
        d = [1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2]]
        if all(0 <= x <= k for k, x in enumerate(d, 1)):
            return d
    return [0.5, 1.0, 1.5]


class Brute:
    def __init__(self, texts, order):
        self.order, self.raw, grams = order, Counter(), Counter()
        for text in texts:
            t = tokens(text)
            self.raw.update(t)
            padded = [START] * (order - 1) + t
            grams.update(tuple(padded[i:i + order]) for i in range(len(t)))
        self.levels = {order: grams}
        for n in range(order - 1, 0, -1):
            self.levels[n] = Counter(g[1:] for g in self.levels[n + 1])
        self.d = {n: discounts(c) for n, c in self.levels.items()}
        self.of = defaultdict(list)
        for n, counts in self.levels.items():
            for g, c in counts.items():
                self.of[n, g[:-1]].append(c)

    def p(self, context, word, n=None):
        n = self.order if n is None else n
        if n == 0:
            return 1 / (len(self.raw) + 1)
        context = context[len(context) - n + 1:] if n > 1 else ()
        lower = self.p(context[1:], word, n - 1)
        seen = self.of.get((n, context))
        if not seen:
            return lower
        c = self.levels[n].get((*context, word), 0)
        cut = [0, *self.d[n]]
        return (c - cut[min(c, 3)] + sum(cut[min(x, 3)] for x in seen) * lower) / sum(seen)

    def score(self, text):
        t = tokens(text)
        padded = [START] * (self.order - 1) + t
        return sum(math.log10(self.p(tuple(padded[i:i + self.order - 1]), w)) for i, w in enumerate(t))

    def base(self, text):
        n, v = sum(self.raw.values()), len(self.raw)
        return sum(math.log10((self.raw[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens(text))


def held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 1


ODD = [(901, None), (902, ""), (903, " \n\t "), (None, "the end"), (905, "The THE the " * 500), (905, "other"), (906, "w" * 20000 + " é É"),
       (907, "never-seen-before words")]


@pytest.mark.parametrize("order,shard", [(2, 1 << 22), (2, 3000), (3, 5000)])
def test_against_plain_python(spark, monkeypatch, order, shard):
    monkeypatch.setattr(kneser_ney, "SHARD", shard)  # small shards: many files and frequent words
    rows = [(r["doc_id"], r["text"]) for r in read_table(spark, SF_SMALL, "documents").select("doc_id", "text").limit(60).collect()] + ODD
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    model = Brute([t for i, t in rows if not held_out(i)], order)
    want = sorted((str(i), held_out(i), len(tokens(t)), sum(model.raw[w] > 0 for w in tokens(t)), sum(model.raw.values()),
                   round(model.base(t), 5), round(model.score(t), 5)) for i, t in rows)
    got = sorted((str(r[0]), *r[1:5], round(r[5], 5), round(r[6], 5)) for r in kneser_ney.score(docs, order).collect())
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-9, atol=2e-5)


def test_probabilities_sum_to_one(spark):
    texts = ["a b c a b d", "a b a c", "b b b a c d e", "a a a a b"]
    model = kneser_ney.fit(spark.createDataFrame([(t,) for t in texts], "text string"), order=3)
    words = sorted({w for t in texts for w in t.split()}) + ["unknown", ""]  # the empty text is the end
    for context in ("a b", "b", "zz a", "zz zz", ""):
        total = 0.0
        for w in words:
            (s,) = textbytes.slices(pa.array([f"{context} {w}"]))
            t, doc, at = kneser_ney.tokens(s)
            total += model.probabilities(t >> np.uint64(16), doc, at)[-1 if w == "" else -2]
        assert total == pytest.approx(1, abs=1e-12)


def test_blocks_and_files_round_trip(tmp_path):
    columns = [np.sort(np.random.RandomState(1).randint(0, 1 << 62, 500).astype(np.uint64)), np.arange(500, dtype=np.uint64) << np.uint64(40)]
    assert all((a == b).all() for a, b in zip(columns, kneser_ney.unpack(kneser_ney.pack(columns))))
    arrays = kneser_ney._with_counts(columns[0], np.array([1, 254, 255, 1 << 40] * 125))
    mapped.write(f"{tmp_path}/x/1", arrays)
    back = mapped.read(f"file://{tmp_path}/x/1", ("<u8", "<u1", "<u8", "<i8"))
    assert all((a == b).all() for a, b in zip(arrays, back)) and mapped.read(f"{tmp_path}/none", ("<u8",)) is None


def test_no_training_texts_and_empty_table(spark):
    docs = spark.createDataFrame([(i, "a b") for i in range(40) if held_out(i)], "doc_id long, text string")
    assert {(r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in kneser_ney.score(docs).collect()} == {(0, 0, 0.0, 0.0)}
    assert kneser_ney.score(docs.limit(0)).count() == 0


def test_equals_sql_and_beats_the_base_on_unseen_texts(spark):
    out = op13_lm_score(spark, SF_SMALL)
    assert compare(out, kneser_ney.ORACLE_SQL, duck(SF_SMALL)) == []
    held = [r for r in out.collect() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
