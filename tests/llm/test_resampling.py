"""op11: hashed features against zlib, weights and draws against plain Python, and odd rows."""

import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
from oracle_check import compare, duck

from conftest import SF_SMALL
from txnscore.llm import resampling, textbytes
from txnscore.llm.queries import op11_importance_resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def runs(text, longest):
    w = WORD.findall(lower(text))
    return [" ".join(w[i:i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)], len(w)


def brute(docs, target, longest, buckets, percent, min_words, seed):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = [0] * buckets, [0] * buckets
    for _, text in docs:
        for f in runs(text, longest)[0]:
            s[bucket(f)] += 1
    for text in target:
        for f in runs(text, longest)[0]:
            t[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    rows = []
    for doc_id, text in docs:
        found, n = runs(text, longest)
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(f)] for f in found)
        rows.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n])
    fit = sorted((r for r in rows if r[4] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    drawn = fit[:percent * len(fit) // 100]
    return sorted((str(r[:4]), next((k for k, d in enumerate(drawn, 1) if d is r), 0)) for r in rows)


def got(df):
    return sorted((str([r["doc_id"], r["n_features"], r["weight"], r["score"]]), r["rank"] or 0) for r in df.collect())


DOCS = [(1, "Alpha beta gamma, alpha BETA!"), (2, None), (3, ""), (4, "  \n\t"), (5, "é ünï 日本語 日本語 x"), (None, "alpha beta beta"),
        (7, "z" * 5000 + " " + "yx" * 40 + " alpha"), (8, "alpha beta"), (8, "alpha beta"), (8, "gamma"), (9, "0-9 a_b\x00c\x7fd"), (10, "beta alpha " * 3000)]


def test_crc_of_spans_equals_zlib():
    words = ["", "a", "abcdefgh", "abcdefgh", "abcdefghi", "é", "日本語" * 9, "x" * 64, "x" * 65, "q" * 1000]
    data = "".join(words).encode()
    at = textbytes.bounds(np.array([len(w.encode()) for w in words]))
    out = resampling.crc32_spans(np.frombuffer(data, np.uint8), at[:-1], at[1:])
    assert out.tolist() == [zlib.crc32(w.encode()) for w in words]


def test_words_joined_by_one_blank():
    (s,) = textbytes.slices(pa.array(["A--b  c", "d"]))
    bucket, doc, n = resampling.features(s, 2, 10_000)
    assert sorted(zip(doc, bucket)) == sorted((d, zlib.crc32(f) % 10_000) for d, f in
                                              [(0, b"a"), (0, b"b"), (0, b"c"), (0, b"a b"), (0, b"b c"), (1, b"d")])
    assert n.tolist() == [3, 1]


def test_against_plain_python(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").repartition(5)
    target = ["alpha alpha beta", None, "日本語 gamma"]
    frame = spark.createDataFrame([(t,) for t in target], "text string")
    for longest, percent, least in ((1, 50, 2), (2, 100, 1), (3, 34, 0)):
        out = resampling.resample(docs, frame, longest, 97, percent, least, seed=5)
        assert got(out) == brute(DOCS, target, longest, 97, percent, least, 5)


def test_text_ids_extra_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([("b", "one two", 3), ("a", "one two", 4)], "doc_id string, text string, rank int")
    none = docs.limit(0)
    out = resampling.resample(docs, none, min_words=1, percent=100).collect()
    assert sorted(r["rank"] for r in out) == [1, 2] and out[0].__fields__ == ["doc_id", "n_features", "weight", "score", "rank"]
    assert resampling.resample(none, docs).count() == 0


def test_equals_sql(spark):
    assert compare(op11_importance_resampling(spark, SF_SMALL), resampling.ORACLE_SQL, duck(SF_SMALL)) == []
