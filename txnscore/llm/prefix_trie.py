"""Prefix trie of conversations by collapsing whole sequences.

1. Every turn becomes a 128-bit digest of its position, role and text; the digests of a prefix are
   combined by exclusive or, so that a running aggregate gives the key of every prefix.
2. Equal conversations collapse into one weighted sequence with the list of those that end there. All further
   steps read the distinct sequences only.
3. The prefixes of the sequences, weighted, are aggregated by key into the nodes.
4. Sequences that are proper prefixes of others leave by an anti-join; the rest are the leaves.
5. Subtree sums need no walk over the tree. Over the members of a node, the bytes from its depth on are
   sum(weight * bytes) - members * bytes before it: one more sum over weighted prefixes. The bytes of the
   subtree's distinct nodes follow by counting each node for its smallest member: the nodes with one
   smallest member form a chain down to that member's end, so each sequence brings the bytes of its chain.

Rows of turns and prefixes carry digests and lengths, not texts. No step gathers a conversation or
a group of equal ones: long conversations are handled in blocks of ``BLOCK`` turns with offsets
between the blocks, all aggregates over keys combine partially before their shuffle, and the one inherently
sequential step, the digest of a long end list, streams packed pieces that range-sorted tasks have made.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .duck import CRC_CTE, crc32
from .graph import checked
from .order import group_positions
from .tables import cut

#: Turns of one conversation that one group of a window or join may hold.
BLOCK = 1024

#: Parents with more children than this meet their children apart from the others.
MANY_CHILDREN = 10_000

#: Characters of one packed piece of an end list.
PIECE = 1 << 16

KEY = ["k1", "k2", "depth"]


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, j, d1, d2, bytes): turns in order (turn, null first; then role and the text's md5), j from
    0, with the digest of role and text and the text's UTF-8 bytes. A null role or text counts as
    empty; turns with a null conv_id belong to no conversation."""
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn"),
                                F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                                F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).filter("conv_id is not null")
    rows = rows.select("conv_id", "turn", "role", F.md5(F.col("text").cast("binary")).alias("of_text"),
                       F.xxhash64("role", "text").alias("d1"), F.xxhash64("text", F.lit(7), "role").alias("d2"),
                       F.octet_length("text").cast("long").alias("bytes"))
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("of_text")]
    return group_positions(rows, "conv_id", order, "j").select("conv_id", "j", "d1", "d2", "bytes")


def _placed(pos: Column, part: int) -> Column:
    return F.xxhash64(F.lit(part), pos, "d1", "d2")


def branch(turns: DataFrame, siblings: int, most: int, seed: Column) -> tuple[DataFrame, DataFrame]:
    """Conversations that go on from the head of another one.

    Conversation c takes the first h turns of conversation c - c % ``siblings`` (all if fewer, none if
    there is none) and then its own turns after its first h, where h = ``seed`` (an expression of
    conv_id) is below ``most``. Returns the conversations (conv_id, n own turns, n_lead, lead) and their own turns that
    stay (conv_id, block, pos, p1, p2, bytes); ``lead`` holds the up to ``most - 1`` turns in front.
    """
    ids = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    ids = ids.withColumn("h", seed.cast("long")).withColumn("base", F.col("conv_id") - F.col("conv_id") % siblings)
    head = F.struct("j", _placed(F.col("j"), 1).alias("p1"), _placed(F.col("j"), 2).alias("p2"), "bytes")
    # at most ``most`` turns of each conversation
    heads = (turns.filter((F.col("j") < most - 1) & (F.col("conv_id") % siblings == 0))
             .groupBy(F.col("conv_id").alias("base")).agg(F.array_sort(F.collect_list(head)).alias("head")))
    lead = F.filter(F.coalesce("head", F.array().cast("array<struct<j:bigint,p1:bigint,p2:bigint,bytes:bigint>>")), lambda x: x["j"] < F.col("h"))
    ids = cut(ids.join(heads, "base", "left").select("conv_id", "n", "h", lead.alias("lead")))
    # one row per block, so that no join key meets more than BLOCK turns
    blocks = _blocks_of(ids, "h", F.size("lead").alias("n_lead"))
    own = turns.withColumn("block", F.floor(F.col("j") / BLOCK)).join(blocks, ["conv_id", "block"]).filter("j >= h")
    pos = F.col("n_lead") + F.col("j") - F.col("h")
    own = own.select("conv_id", "block", pos.alias("pos"), _placed(pos, 1).alias("p1"), _placed(pos, 2).alias("p2"), "bytes")
    return ids.select("conv_id", "n", F.size("lead").cast("long").alias("n_lead"), "lead"), cut(own)


def _xor(array: str, field: str) -> Column:
    return F.aggregate(array, F.lit(0).cast("long"), lambda acc, x: acc.bitwiseXOR(x[field]))


def _total(array: str) -> Column:
    return F.aggregate(array, F.lit(0).cast("long"), lambda acc, x: acc + x["bytes"])


def whole_sequences(ids: DataFrame, own: DataFrame) -> DataFrame:
    """(conv_id, k1, k2, depth, total): key, number of turns and bytes of every conversation."""
    sums = own.groupBy("conv_id").agg(F.bit_xor("p1").alias("x1"), F.bit_xor("p2").alias("x2"), F.sum("bytes").alias("b"),
                                      F.count(F.lit(1)).alias("m"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return ids.join(sums, "conv_id", "left").select(
        "conv_id", _xor("lead", "p1").bitwiseXOR(zero("x1")).alias("k1"), _xor("lead", "p2").bitwiseXOR(zero("x2")).alias("k2"),
        (F.col("n_lead") + zero("m")).alias("depth"), (_total("lead") + zero("b")).alias("total"))


def _blocks_of(sequences: DataFrame, *columns: str) -> DataFrame:
    """Rows per block of a sequence, to be joined to its turns by (conv_id, block)."""
    last = F.floor((F.col("n") - 1) / BLOCK)
    return sequences.select("conv_id", *columns, F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"))


def prefixes(sequences: DataFrame, own: DataFrame) -> DataFrame:
    """(conv_id, block, k1, k2, depth, p1, p2, cum, bytes, weight, total, length): every prefix of every
    sequence, the root included. ``p1`` and ``p2`` lead back to the parent's key, ``cum`` is the bytes
    up to here, ``bytes`` those of the last turn; ``block`` is -1 for the root and the lead."""
    each = ["weight", "total", "length"]
    up_to = Window.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    facts = _blocks_of(sequences, "n", *each, _xor("lead", "p1").alias("x1"), _xor("lead", "p2").alias("x2"), _total("lead").alias("b"))
    inner = cut(own.join(facts, ["conv_id", "block"]).select(
        "conv_id", "block", "n", F.bit_xor("p1").over(up_to).alias("r1"), F.bit_xor("p2").over(up_to).alias("r2"),
        (F.col("pos") + 1).alias("depth"), "p1", "p2", F.sum("bytes").over(up_to).alias("r"), "bytes", *each, "x1", "x2", "b"))
    # what the blocks before add; only conversations of several blocks have a row here
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = inner.filter(F.col("n") > BLOCK).groupBy("conv_id", "block").agg(F.bit_xor("p1").alias("s1"), F.bit_xor("p2").alias("s2"),
                                                                           F.sum("bytes").alias("s"))
    offsets = cut(sums.select("conv_id", "block", F.bit_xor("s1").over(before).alias("o1"), F.bit_xor("s2").over(before).alias("o2"),
                              F.sum("s").over(before).alias("o")).filter("o is not null"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    key = lambda i: F.col(f"r{i}").bitwiseXOR(zero(f"o{i}")).bitwiseXOR(F.col(f"x{i}")).alias(f"k{i}")
    tail = inner.join(checked(offsets, columns=5), ["conv_id", "block"], "left").select(
        "conv_id", "block", key(1), key(2), "depth", "p1", "p2", (F.col("r") + zero("o") + F.col("b")).alias("cum"), "bytes", *each)
    root = F.struct(*[F.lit(0).cast("long").alias(c) for c in ("k1", "k2", "depth", "p1", "p2", "cum", "bytes")])
    step = lambda s, x: F.struct(s["k1"].bitwiseXOR(x["p1"]).alias("k1"), s["k2"].bitwiseXOR(x["p2"]).alias("k2"), (s["depth"] + 1).alias("depth"),
                                 x["p1"].alias("p1"), x["p2"].alias("p2"), (s["cum"] + x["bytes"]).alias("cum"), x["bytes"].alias("bytes"))
    grown = F.aggregate("lead", F.array(root), lambda acc, x: F.concat(acc, F.array(step(F.element_at(acc, -1), x))))
    front = sequences.select("conv_id", *each, F.explode(grown).alias("x")).select(
        "conv_id", F.lit(-1).cast("long").alias("block"), "x.*", *each)
    return cut(tail.unionByName(front))


def end_digests(ends: DataFrame) -> DataFrame:
    """(k1, k2, depth, ends_sha256) of the ids that end at each key, ascending and comma-joined.

    ``ends`` is a materialized table of (k1, k2, depth, conv_id). Range-sorted tasks pack the ids of a
    key into pieces of text; the pieces of a key are then streamed through one hash.
    """

    def pack(batches):
        key, first, ids, size = None, None, [], 0

        def piece():
            columns = [[v] for v in (*key, first, ",".join(ids))]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns[:4]] + [pa.array(columns[4], pa.string())],
                                              names=[*KEY, "first", "piece"])
        for batch in batches:
            for *at, conv_id in zip(*(c.to_pylist() for c in batch.columns)):
                if at != key or size > PIECE:
                    if ids:
                        yield piece()
                    key, first, ids, size = at, conv_id, [], 0
                ids.append(str(conv_id))
                size += len(ids[-1]) + 1
        if ids:
            yield piece()

    def digest(batches):
        key, state, done = None, None, []
        for batch in batches:
            for *at, _, text in zip(*(c.to_pylist() for c in batch.columns)):
                if at == key:
                    state.update(b",")
                else:
                    if key is not None:
                        done.append((*key, state.hexdigest()))
                    key, state = at, hashlib.sha256()
                state.update(text.encode())
            yield out(done)
            done = []
        if key is not None:
            yield out([(*key, state.hexdigest())])

    def out(rows):
        columns = list(zip(*rows)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns[:3]] + [pa.array(columns[3], pa.string())],
                                          names=[*KEY, "ends_sha256"])

    schema = "k1 long, k2 long, depth long"
    pieces = (ends.select(*KEY, "conv_id").repartitionByRange(*KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id")
              .mapInArrow(pack, f"{schema}, first long, piece string"))
    return (pieces.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(digest, f"{schema}, ends_sha256 string"))


def _parents(nodes: DataFrame) -> DataFrame:
    """(k1, k2, depth, parent_conv_id) of the nodes whose parent has another smallest member.

    Parents of many children are looked up in a table of their own, counted and small unless there are
    millions of them; the others meet at most ``MANY_CHILDREN`` children by shuffle.
    """
    up = [F.col("k1").bitwiseXOR(F.col("p1")).alias("u1"), F.col("k2").bitwiseXOR(F.col("p2")).alias("u2"), (F.col("depth") - 1).alias("ud")]
    children = nodes.filter("depth > 0 and depth = top").select(*KEY, *up)
    parents = nodes.filter("n_children > 0").select(F.col("k1").alias("u1"), F.col("k2").alias("u2"), F.col("depth").alias("ud"),
                                                    F.col("conv_id").alias("parent_conv_id"), "n_children")
    large = cut(parents.filter(F.col("n_children") > MANY_CHILDREN).drop("n_children"))
    hinted = checked(large, columns=4)
    small = parents.filter(F.col("n_children") <= MANY_CHILDREN).drop("n_children")
    on = ["u1", "u2", "ud"]
    return (children.join(hinted, on).select(*KEY, "parent_conv_id")
            .union(children.join(hinted, on, "left_anti").join(small, on).select(*KEY, "parent_conv_id")))


def trie(ids: DataFrame, own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes and ends of the trie of the conversations that ``branch`` describes.

    Nodes: key (k1, k2, depth), conv_id (smallest member), parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, cum and bytes (text bytes up to and at the node). Ends: (k1, k2, depth,
    conv_id), one row per conversation, at the node of its last turn.
    """
    whole = cut(whole_sequences(ids, own))
    sequences = whole.groupBy(*KEY).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("weight"), F.max("total").alias("total"))
    sequences = cut(sequences.join(ids, "conv_id"))
    rows = prefixes(sequences.withColumn("length", F.col("depth")).drop("depth"), own)
    nodes = cut(rows.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.sum("weight").alias("n_convs"), F.sum(F.col("weight") * F.col("total")).alias("of_members"),
        F.max("length").alias("longest"), F.min("cum").alias("cum"), F.min("bytes").alias("bytes"), F.min("p1").alias("p1"), F.min("p2").alias("p2")))

    # leaves: sequences that are no proper prefix of another one; and what the chain of each sequence brings
    leaves = sequences.join(nodes.filter("longest > depth").select(*KEY), KEY, "left_anti").select("conv_id", F.lit(1).cast("long").alias("leaf"))
    chains = nodes.groupBy("conv_id").agg(F.min("depth").alias("top"), F.min(F.col("cum") - F.col("bytes")).alias("above"))
    brings = cut(sequences.select("conv_id", "n", "total").join(leaves, "conv_id", "left").join(chains, "conv_id", "left").select(
        "conv_id", "n", F.coalesce("leaf", F.lit(0)).alias("leaf"), "top", "above", F.coalesce(F.col("total") - F.col("above"), F.lit(0)).alias("brought")))
    facts = ["leaf", "top", "above", "brought"]
    by_block = _blocks_of(brings, *facts).union(brings.select("conv_id", *facts, F.lit(-1).cast("long")))
    sums = rows.select("conv_id", "block", *KEY).join(by_block, ["conv_id", "block"]).groupBy(*KEY).agg(
        F.sum("leaf").alias("n_leaves"), F.sum("brought").alias("brought"),
        F.min_by("above", "conv_id").alias("above"), F.min_by("top", "conv_id").alias("top"))
    children = nodes.filter("depth > 0").groupBy(F.col("k1").bitwiseXOR(F.col("p1")).alias("k1"), F.col("k2").bitwiseXOR(F.col("p2")).alias("k2"),
                                                 (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    before = F.col("cum") - F.col("bytes")
    saved = (F.col("of_members") - F.col("n_convs") * before) - (F.col("brought") + F.col("above") - before)
    nodes = cut(nodes.join(sums, KEY).join(children, KEY, "left").select(
        *KEY, "conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves", saved.alias("saved_tokens"),
        "top", "cum", "bytes", "p1", "p2"))
    parent = F.when(F.col("depth") > 0, F.coalesce("parent_conv_id", "conv_id"))
    full = nodes.join(_parents(nodes), KEY, "left").select(
        *KEY, "conv_id", parent.alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", "cum", "bytes")
    return full, whole.select(*KEY, "conv_id")


def branched_trie(conversations: DataFrame, siblings: int = 5, most: int = 9) -> DataFrame:
    """The trie of ``conversations`` (conv_id, turn, role, text), each rebuilt on the first h turns of
    conversation c - c % ``siblings``, h = crc32(c as text) % ``most`` (see ``branch``).

    One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and
    ends_sha256. Null turns come first, turns of one number are ordered by role and the text's md5 and all
    count, repeated rows too; null roles and texts count as empty; turns with a null conv_id belong
    to none. An empty table has no conversation and so no node, not even a root; other columns are ignored.
    """
    seed = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    ids, own = branch(cut(ordered_turns(conversations)), siblings, most, seed)
    nodes, ends = trie(ids, own)
    return nodes.join(end_digests(ends), KEY, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


ORACLE_SQL = f"""WITH {CRC_CTE},
  turns AS (SELECT conv_id, {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS x, row_number() OVER (PARTITION BY conv_id
      ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) - 1 AS j FROM conversations WHERE conv_id IS NOT NULL),
  convs AS (SELECT conv_id, list(x ORDER BY j) AS own FROM turns GROUP BY 1),
  plan AS (SELECT conv_id, own, conv_id - conv_id % 5 AS base, {crc32('CAST(conv_id AS VARCHAR)')} % 9 AS h FROM convs, crc),
  rebuilt AS (SELECT p.conv_id, list_concat(coalesce(b.own, [])[1:h], p.own[h + 1:]) AS s FROM plan p LEFT JOIN convs b ON b.conv_id = p.base),
  pre AS (SELECT conv_id, len(s) AS n, s, unnest(range(len(s) + 1)) AS depth FROM rebuilt),
  members AS (SELECT conv_id, n, depth, s[1:depth] AS p FROM pre),
  nodes AS (SELECT p, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
      coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n = depth), '') AS ends FROM members GROUP BY 1, 2),
  kids AS (SELECT p[1:depth - 1] AS p, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
  full_nodes AS (SELECT n.p, n.depth, n.conv_id, n.n_convs, n.ends, coalesce(n_children, 0) AS n_children,
      CASE WHEN n.depth > 0 THEN (n_convs - 1) * strlen(n.p[n.depth].text) ELSE 0 END AS own_saved FROM nodes n LEFT JOIN kids ON kids.p = n.p),
  up AS (SELECT p[1:d] AS p, n_children, own_saved FROM (SELECT *, unnest(range(depth + 1)) AS d FROM full_nodes)),
  sums AS (SELECT p, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(own_saved)::BIGINT AS saved_tokens FROM up GROUP BY 1)
  SELECT n.conv_id, n.depth, CASE WHEN n.depth > 0 THEN u.conv_id END AS parent_conv_id, n.n_convs, n.n_children, n_leaves, saved_tokens,
    sha256(n.ends) AS ends_sha256
  FROM full_nodes n JOIN sums ON sums.p = n.p LEFT JOIN nodes u ON u.p = n.p[1:n.depth - 1] AND n.depth > 0"""
