"""op12 against a trie built in plain Python, with long conversations, ties, nulls and missing bases."""

import hashlib
import random
import zlib

from oracle_check import compare, duck

from conftest import SF_SMALL
from txnscore.llm import prefix_trie
from txnscore.llm.queries import op12_prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", hashlib.md5((text or "").encode()).hexdigest(), text or ""))
    own = {c: [(r, t) for _, _, r, _, t in sorted(v)] for c, v in own.items()}
    convs = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        convs[c] = tuple(own.get(c - int(c % 5), [])[:h] + own[c][h:])
    nodes = {}
    for c, s in convs.items():
        for d in range(len(s) + 1):
            nodes.setdefault(s[:d], []).append(c)
    kids = {p: 0 for p in nodes}
    for p in nodes:
        if p:
            kids[p[:-1]] += 1
    leaves, saved = {p: 0 for p in nodes}, {p: 0 for p in nodes}
    for p, members in nodes.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += kids[p] == 0
            saved[p[:d]] += (len(members) - 1) * len(p[-1][1].encode()) if p else 0
    ends = lambda p: ",".join(str(c) for c in sorted(nodes[p]) if len(convs[c]) == len(p))
    return sorted((min(m), len(p), min(nodes[p[:-1]]) if p else -1, len(m), kids[p], leaves[p], saved[p],
                   hashlib.sha256(ends(p).encode()).hexdigest()) for p, m in nodes.items())


def got(df):
    return sorted((r["conv_id"], r["depth"], -1 if r["parent_conv_id"] is None else r["parent_conv_id"], r["n_convs"], r["n_children"],
                   r["n_leaves"], r["saved_tokens"], r["ends_sha256"]) for r in df.collect())


def conversations(n, seed, texts, longest=9):
    r = random.Random(seed)
    return [(c, t, r.choice(["user", "bot", None]), r.choice(texts)) for c in range(n) if r.random() < 0.9 for t in range(r.randint(1, longest))]


def test_random_conversations(spark):
    rows = conversations(150, 3, ["a", "bb", "é日", None, ""])
    rows += [(7, None, "user", "first"), (None, 1, "user", "nobody's"), (8, 1, "user", "tie"), (8, 1, "user", "tie"), (8, 1, "bot", "tie")]
    assert got(prefix_trie.branched_trie(spark.createDataFrame(rows, SCHEMA).repartition(7))) == brute(rows)


def test_few_texts_give_shared_sequences_and_proper_prefixes(spark):
    rows = [(c, t, "user", "x") for c in range(60) for t in range(1 + c % 12)]
    assert got(prefix_trie.branched_trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_long_conversations_run_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 4)
    monkeypatch.setattr(prefix_trie, "MANY_CHILDREN", 2)
    monkeypatch.setattr(prefix_trie, "PIECE", 8)
    rows = [(c, t, "user", "same" if t < 15 + c else f"{c}-{t}") for c in range(12) for t in range(40 if c % 5 else 12)]
    rows += [(c, 0, "user", f"{c % 7}") for c in range(100, 140)]
    assert got(prefix_trie.branched_trie(spark.createDataFrame(rows, SCHEMA).repartition(9))) == brute(rows)


def test_one_conversation_over_many_ranges(spark):
    rows = [(5, t, "user", f"{t % 3}" * 5) for t in range(250)] + [(6, t, "user", "z") for t in range(3)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(16)
    assert got(prefix_trie.branched_trie(frame)) == brute(rows)


def test_empty_table_and_extra_columns(spark):
    rows = [(1, 1, "user", "a")]
    frame = spark.createDataFrame([(*r, 9, 9) for r in rows], SCHEMA + ", depth long, k1 long")
    assert got(prefix_trie.branched_trie(frame)) == brute(rows)
    assert prefix_trie.branched_trie(frame.limit(0)).count() == 0


def test_equals_sql(spark):
    assert compare(op12_prefix_trie(spark, SF_SMALL), prefix_trie.ORACLE_SQL, duck(SF_SMALL)) == []
