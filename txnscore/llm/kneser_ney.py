"""Interpolated modified Kneser-Ney language model: counted in Spark, kept as sorted hash arrays that
the workers map into memory.

Counting. The n-grams of the highest order are counted in the scan, combined per task, and leave
it as compressed blocks, one per shard of a hash range, so that a shuffled n-gram costs a few bytes. The task of
a shard adds its blocks up and writes the shard's sorted array of hashes with counts. From the
distinct n-grams follow, again as blocks, the facts of their contexts (occurrences, and how many
successors occur once, twice or more often) and the n-grams of the next lower order, each counted by its
distinct predecessors. Each order is one more exchange; the driver sees one row per order.

N-grams lie in the shard of their context, and in one of their own where the context's last word is
frequent, so that the many successors of a frequent word spread over all shards.

Scoring. A worker maps the arrays it needs, looks the distinct words, contexts and n-grams of a piece of the
corpus up in sorted order, and adds log10 probabilities per text:

    p_n(w | context) = (c - D(c)) / total(context) + (D1 n1 + D2 n2 + D3 n3) / total(context) * p_(n-1)(w | shorter context)

with D1, D2, D3+ per order from its numbers of n-grams that occur one to four times, an unknown context handing over to
the shorter one, and the uniform distribution over the vocabulary and one unknown word below the unigrams.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from . import mapped
from . import textbytes as tb
from .blocks import bits_for, cuts, pack, shard_of, unpack
from .duck import CRC_CTE, crc32, lower_ascii
from .tables import cut, fold

#: Tokens per shard: bounds what the task of a shard holds (about 100 bytes each).
SHARD = 1 << 22

#: N-grams that a task combines before it lets blocks go.
HELD = 1 << 21

#: Bytes of text whose lookups are made together.
PIECE_BYTES = 1 << 22

_END, _START = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
_BY = np.uint64(0x9E3779B97F4A7C15)

#: Word hashes in n-grams have 48 bits, which saves a fifth of a block; the unigram counts use 64.
_SHORT = np.uint64(16)

_WORDS, _GRAMS, _CONTEXTS = ("<u8", "<u1", "<u8", "<i8"), ("<u8", "<u1", "<u8", "<i8"), ("<u8", "<i8", "<u4", "<u4", "<u4")
_SUMS = ["n1", "n2", "n3", "n4", "n", "total"]
_BLOCKS = "level int, kind string, shard int, block binary, " + ", ".join(f"{c} long" for c in _SUMS)


def tokens(s: tb.Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hash and text of every token (A-Z lower-cased words, and an end after each text), and the
    texts' offsets in them."""
    start, end, doc = tb.words(s)
    at = tb.bounds(tb.counts(doc, s.n) + 1)
    out = np.full(at[-1], _END, np.uint64)
    out[np.arange(len(start)) + doc] = tb.span_hash(tb.prefix_hash(tb.LOWER[s.buf]), start, end)
    return out, np.repeat(np.arange(s.n), np.diff(at)), at


def contexts(words: np.ndarray, doc: np.ndarray, at: np.ndarray, order: int) -> list[np.ndarray]:
    """Hash of the last 1, 2, ... ``order - 1`` words before every token; texts begin with start marks."""
    place = np.arange(len(words)) - at[doc]
    out: list[np.ndarray] = []
    for m in range(1, order):
        before = np.where(place >= m, np.append(np.full(m, _START >> _SHORT), words)[:len(words)], _START >> _SHORT)
        out.append(before if m == 1 else tb.mix(out[-1] * _BY + before))
    return out


def _among(sorted_values: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(values), bool)
    return sorted_values[np.minimum(np.searchsorted(sorted_values, values), len(sorted_values) - 1)] == values


def _prefixed(route: np.ndarray, full: np.ndarray, bits: int) -> np.ndarray:
    """``full`` behind the first ``bits`` of ``route``, which say the shard."""
    if not bits:
        return full
    keep = np.uint64(64 - bits)
    return (route >> keep << keep) | (full >> np.uint64(bits))


def gram_keys(context: np.ndarray, last: np.ndarray, word: np.ndarray, frequent: np.ndarray, bits: int) -> np.ndarray:
    """Sort keys of n-grams, given the hash and the last word of their contexts."""
    full = tb.mix(tb.mix(context) + word * _BY)
    return _prefixed(np.where(_among(frequent, last), full, tb.mix(context)), full, bits)


def _combined(key: np.ndarray, columns: list[np.ndarray], sums: list[np.ndarray]):
    """Rows by distinct key, in its order: the first row's columns and the sums."""
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else order
    add = (lambda x: np.add.reduceat(x[order], first)) if len(key) else (lambda x: x)
    return key[first], [c[order[first]] for c in columns], [add(x) for x in sums]


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.string(), pa.int32(), pa.binary(), *[pa.int64()] * len(_SUMS)]
    columns = list(zip(*rows)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["level", "kind", "shard", "block", *_SUMS])


def _blocks(level: int, kind: str, key: np.ndarray, columns: list[np.ndarray], bits: int):
    """One row per shard of the rows sorted by ``key``; in a block they are sorted by the first column."""
    at = cuts(shard_of(key, bits), bits)
    for k in np.flatnonzero(np.diff(at)):
        order = np.argsort(columns[0][at[k]:at[k + 1]]) + at[k]
        yield _rows([(level, kind, int(k), pack([c[order] for c in columns]), *[0] * len(_SUMS))])


def _level_key(columns: list[np.ndarray], frequent: np.ndarray, bits: int) -> np.ndarray:
    """Sort key of n-grams given as (context, shorter contexts ..., word)."""
    return gram_keys(columns[0], columns[-2], columns[-1], frequent, bits) if len(columns) > 1 else tb.mix(columns[0])


def _counted(texts: DataFrame, order: int, bits: int, frequent_path: str) -> DataFrame:
    """Blocks of the highest order: contexts from long to short, word, count."""

    def run(batches):
        frequent = mapped.read(frequent_path, ("<u8",))[0]
        held: list[list[np.ndarray]] = []

        def flush():
            columns = [np.concatenate(c) for c in zip(*held)]
            key, grams, (n,) = _combined(_level_key(columns[:-1], frequent, bits), columns[:-1], columns[-1:])
            held.clear()
            return _blocks(order, "grams", key, [*grams, n], bits)

        for batch in batches:
            for s in tb.slices(batch.column(0)):
                words, doc, at = tokens(s)
                words = words >> _SHORT
                columns = [*contexts(words, doc, at, order)[::-1], words]
                _, grams, (n,) = _combined(_level_key(columns, frequent, bits), columns, [np.ones(len(words), np.int64)])
                held.append([*grams, n])
                if sum(len(x[-1]) for x in held) >= HELD:
                    yield from flush()
        if held:
            yield from flush()

    return texts.mapInArrow(run, _BLOCKS)


def _with_counts(key: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    """Keys, counts of up to 254 in a byte each (255: see the rest), keys and counts of the rest."""
    large = n >= 255
    return [key.astype("<u8"), np.minimum(n, 255).astype("<u1"), key[large].astype("<u8"), n[large].astype("<i8")]


def _tally(n: np.ndarray) -> list[int]:
    return [int((n == k).sum()) for k in (1, 2)] + [int((n >= 3).sum()), int((n == 3).sum()), int((n == 4).sum())]


def _merged(blocks: DataFrame, bits: int, folder: str, frequent_path: str) -> DataFrame:
    """Add the blocks of every shard up, write its file, and hand on what the next order needs."""

    def grams(level: int, shard: int, parts: list[list[np.ndarray]], frequent: np.ndarray):
        columns = [np.concatenate(c) for c in zip(*parts)]
        key, of, (n,) = _combined(_level_key(columns[:-1], frequent, bits), columns[:-1], [columns[-1].astype(np.int64)])
        mapped.write(f"{folder}/grams-{level}/{shard}", _with_counts(key, n))
        once, twice, more, three, four = _tally(n)
        yield _rows([(level, "sums", 0, None, once, twice, three, four, len(n), int(n.sum()))])
        if level == 1:
            return
        ones = [(n == 1).astype(np.int64), (n == 2).astype(np.int64), (n >= 3).astype(np.int64)]
        at, (context,), facts = _combined(tb.mix(of[0]), of[:1], [n, *ones])
        yield from _blocks(level, "contexts", at, [context, *facts], bits)
        short = of[1:]
        key, short, (n,) = _combined(_level_key(short, frequent, bits), short, [np.ones(len(n), np.int64)])
        yield from _blocks(level - 1, "grams", key, [*short, n], bits)

    def facts(level: int, shard: int, parts: list[list[np.ndarray]]):
        columns = [np.concatenate(c) for c in zip(*parts)]
        key, _, sums = _combined(tb.mix(columns[0]), [], [c.astype(np.int64) for c in columns[1:]])
        mapped.write(f"{folder}/contexts-{level}/{shard}", [a.astype(t) for a, t in zip([key, *sums], _CONTEXTS)])

    def run(batches):
        frequent = mapped.read(frequent_path, ("<u8",))[0]
        at, parts = None, []

        def done():
            if at is None or not parts:
                return
            kind, level, shard = at
            if kind == "grams":
                yield from grams(level, shard, parts, frequent)
            else:
                facts(level, shard, parts)
            parts.clear()

        for batch in batches:
            for k in range(batch.num_rows):
                kind = batch.column(1)[k].as_py()
                if kind == "sums":
                    yield batch.slice(k, 1)
                    continue
                here = (kind, batch.column(0)[k].as_py(), batch.column(2)[k].as_py())
                if here != at:
                    yield from done()
                    at = here
                parts.append(unpack(batch.column(3)[k].as_buffer()))
        yield from done()

    keys = ["kind", "level", "shard"]
    return blocks.repartition(4 << bits, *keys).sortWithinPartitions(*keys).mapInArrow(run, _BLOCKS)


def _word_counts(texts: DataFrame) -> DataFrame:
    """(h, c): occurrences of every token."""

    def run(batches):
        held: list[list[np.ndarray]] = []

        def flush():
            key, _, (n,) = _combined(np.concatenate([x[0] for x in held]), [], [np.concatenate([x[1] for x in held])])
            held.clear()
            for lo in range(0, len(key), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(key[lo:lo + (1 << 16)].view(np.int64)), pa.array(n[lo:lo + (1 << 16)])], names=["h", "c"])

        for batch in batches:
            for s in tb.slices(batch.column(0)):
                words = tokens(s)[0]
                key, _, (n,) = _combined(words, [], [np.ones(len(words), np.int64)])
                held.append([key, n])
                if sum(len(x[0]) for x in held) >= HELD:
                    yield from flush()
        if held:
            yield from flush()

    return texts.mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


def _write_words(words: DataFrame, bits: int, folder: str) -> None:
    def run(batches):
        at, parts = None, []

        def done():
            key, _, (n,) = _combined(np.concatenate([x[0] for x in parts]), [], [np.concatenate([x[1] for x in parts])])
            mapped.write(f"{folder}/words/{at}", _with_counts(key, n))
            parts.clear()

        for batch in batches:
            shard = batch.column(0).to_numpy()
            for lo, hi in zip(first := np.flatnonzero(np.diff(shard, prepend=-1)), np.append(first[1:], len(shard))):
                if shard[lo] != at and parts:
                    done()
                at = int(shard[lo])
                parts.append([batch.column(c).slice(lo, hi - lo).to_numpy() for c in (1, 2)])
                parts[-1][0] = parts[-1][0].view(np.uint64)
        if parts:
            done()
        yield pa.RecordBatch.from_arrays([pa.array([], pa.int32())], names=["done"])

    shard = F.shiftrightunsigned("h", 64 - bits).cast("int") if bits else F.lit(0)
    (words.select(shard.alias("shard"), "h", "c").repartition(4 << bits, "shard").sortWithinPartitions("shard")
     .mapInArrow(run, "done int").count())


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """D1, D2, D3+ from the numbers of n-grams counted once to four times; 0.5, 1, 1.5 where these are
    too few for the estimate."""
    if min(n1, n2, n3, n4) > 0:
        y = n1 / (n1 + 2 * n2)
        found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
        if all(0 <= d <= k for k, d in enumerate(found, 1)):
            return found
    return 0.5, 1.0, 1.5


@dataclass
class Model:
    """Where the arrays are, and the few numbers that belong to them."""

    folder: str
    order: int
    bits: int
    n_tokens: int
    n_words: int
    discount: dict       # order -> D1, D2, D3+
    unigrams: tuple      # sum of the unigrams' counts, and the mass that they leave to all words alike

    def _found(self, kind: str, types: tuple, keys: np.ndarray, shards: np.ndarray) -> list[np.ndarray]:
        """For sorted keys the values behind them (0 where the key is unknown)."""
        out = [np.zeros(len(keys), np.int64) for _ in range(1 if types is not _CONTEXTS else 4)]
        at = np.flatnonzero(np.diff(shards, prepend=-1))
        for lo, hi in zip(at, np.append(at[1:], len(keys))):
            arrays = mapped.read(f"{self.folder}/{kind}/{shards[lo]}", types)
            if arrays is None or not len(arrays[0]):
                continue
            place = np.minimum(np.searchsorted(arrays[0], keys[lo:hi]), len(arrays[0]) - 1)
            known = np.flatnonzero(arrays[0][place] == keys[lo:hi])
            place = place[known]
            if types is _CONTEXTS:
                for column, values in zip(out, arrays[1:]):
                    column[lo + known] = values[place]
                continue
            n = arrays[1][place].astype(np.int64)
            large = np.flatnonzero(n == 255)
            n[large] = arrays[3][np.searchsorted(arrays[2], keys[lo + known[large]])]
            out[0][lo + known] = n
        return out

    def _look_up(self, kind: str, types: tuple, keys: np.ndarray) -> list[np.ndarray]:
        distinct, inverse = np.unique(keys, return_inverse=True)
        return [v[inverse] for v in self._found(kind, types, distinct, shard_of(distinct, self.bits))]

    def _discounted(self, level: int, n: np.ndarray) -> np.ndarray:
        return n - np.array([0.0, *self.discount[level]])[np.minimum(n, 3)]

    def probabilities(self, words: np.ndarray, doc: np.ndarray, at: np.ndarray) -> np.ndarray:
        """p(token | the tokens before it) of every token, given their 48-bit hashes."""
        frequent = mapped.read(f"{self.folder}/frequent", ("<u8",))[0]
        total, left = self.unigrams
        p = np.full(len(words), 1.0 / (self.n_words + 1))
        if total:
            (n,) = self._look_up("grams-1", _GRAMS, tb.mix(words))
            p = self._discounted(1, n) / total + left / total * p
        before = contexts(words, doc, at, self.order)
        for level in range(2, self.order + 1):
            context = before[level - 2]
            total, *ones = self._look_up(f"contexts-{level}", _CONTEXTS, tb.mix(context))
            (n,) = self._look_up(f"grams-{level}", _GRAMS, gram_keys(context, before[0], words, frequent, self.bits))
            left = sum(d * k for d, k in zip(self.discount[level], ones))
            of = np.maximum(total, 1)
            p = np.where(total > 0, self._discounted(level, n) / of + left / of * p, p)
        return p

    def counts(self, words: np.ndarray) -> np.ndarray:
        """Occurrences in the training texts of every token, given their 64-bit hashes."""
        return self._look_up("words", _WORDS, words)[0]


def fit(texts: DataFrame, order: int = 2) -> Model:
    """Count a model of ``order`` (2 or more) over the one text column of ``texts``; null texts are empty."""
    spark = texts.sparkSession
    folder = scratch_path(spark, "kneser-ney")
    words = cut(_word_counts(texts))
    n_tokens, n_words = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    bits = bits_for(n_tokens, SHARD)
    # words that would fill a shard by themselves: at most one per shard
    frequent = words.filter(F.col("c") > SHARD).select("h").toPandas()["h"].to_numpy(np.int64).view(np.uint64)
    frequent_path = f"{folder}/frequent"
    mapped.write(frequent_path, [np.sort(np.append(frequent, [_START, _END]) >> _SHORT).astype("<u8")])
    _write_words(words, bits, folder)
    rows = _counted(texts, order, bits, frequent_path)
    for _ in range(order):
        rows = _merged(rows, bits, folder, frequent_path)
    sums = {r["level"]: r for r in rows.filter("kind = 'sums'").groupBy("level").agg(*[F.sum(c).alias(c) for c in _SUMS]).collect()}
    of = {k: discounts(*[sums[k][c] for c in _SUMS[:4]]) if k in sums else (0.5, 1.0, 1.5) for k in range(1, order + 1)}
    unigrams = (0, 0.0)
    if 1 in sums:
        r = sums[1]
        unigrams = (r["total"], of[1][0] * r["n1"] + of[1][1] * r["n2"] + of[1][2] * (r["n"] - r["n1"] - r["n2"]))
    return Model(folder, order, bits, n_tokens, n_words, of, unigrams)


def evaluate(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) of (doc_id, text); the id keeps its type."""

    def run(batches):
        for batch in batches:
            for s in tb.slices(batch.column(1), PIECE_BYTES):
                words, doc, at = tokens(s)
                n = model.counts(words)
                base = np.log10((n + 0.5) / (model.n_tokens + 0.5 * (model.n_words + 1)))
                p = np.log10(model.probabilities(words >> _SHORT, doc, at))
                # every text has a token; the sums are carried in extended precision
                total = lambda x: np.add.reduceat(x.astype(np.longdouble), at[:-1]).astype(float)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(s.first, s.n), pa.array(np.diff(at)), pa.array(np.add.reduceat((n > 0).astype(np.int64), at[:-1])),
                     pa.array(total(base)), pa.array(total(p))], names=["doc_id", "n_tokens", "n_known", "base_score", "score"])

    fields = [("doc_id", docs.schema["doc_id"].dataType), ("n_tokens", T.LongType()), ("n_known", T.LongType()),
              ("base_score", T.DoubleType()), ("score", T.DoubleType())]
    return docs.mapInArrow(run, T.StructType([T.StructField(*f) for f in fields]))


def score(docs: DataFrame, order: int = 2, folds: int = 5, held_out: int = 1) -> DataFrame:
    """Score every document by a model of the documents whose crc32(doc_id) mod ``folds`` is not ``held_out``.

    One row per input row: doc_id, held_out, n_tokens (words and one end), n_known (tokens that occur in the
    training texts), train_tokens, base_score (add-half unigrams) and score (the model), both log10
    probabilities. A null or empty text is its end alone. A null id counts as the empty text in the hash; repeated
    rows are texts of their own. Without training texts every token is unknown and both scores
    are 0. Other columns are ignored.
    """
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    held = fold(F.col("doc_id"), folds) == held_out
    model = fit(docs.filter(~held).select("text"), order)
    out = evaluate(docs, model)
    return out.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", F.lit(model.n_tokens).cast("long").alias("train_tokens"),
                      "base_score", "score")


def _discount_sql(counts: str, name: str) -> str:
    """CTEs ``name``_n and ``name``_d: numbers of n-grams counted 1 to 4 times in ``counts`` and the discounts."""
    return f"""{name}_n AS (SELECT {", ".join(f"(count(*) FILTER (WHERE c = {k}))::DOUBLE AS n{k}" for k in (1, 2, 3, 4))} FROM {counts}),
  {name}_e AS (SELECT 1 - 2 * y * n2 / n1 AS a, 2 - 3 * y * n3 / n2 AS b, 3 - 4 * y * n4 / n3 AS e, least(n1, n2, n3, n4) > 0 AS fit
    FROM (SELECT *, n1 / (n1 + 2 * n2) AS y FROM {name}_n)),
  {name}_d AS (SELECT CASE WHEN ok THEN a ELSE 0.5 END AS d1, CASE WHEN ok THEN b ELSE 1.0 END AS d2, CASE WHEN ok THEN e ELSE 1.5 END AS d3
    FROM (SELECT *, coalesce(fit AND a BETWEEN 0 AND 1 AND b BETWEEN 0 AND 2 AND e BETWEEN 0 AND 3, FALSE) AS ok FROM {name}_e))"""


_TOKENS = rf"list_append(regexp_extract_all({lower_ascii("coalesce(text, '')")}, '[^\x20\x09-\x0D]+'), ' ')"

#: The model of order 2 in SQL; ' ' is the end, '  ' the start of a text.
ORACLE_SQL = rf"""WITH {CRC_CTE},
  docs AS (SELECT doc_id, {crc32('CAST(doc_id AS VARCHAR)')} % 5 = 1 AS held_out, {_TOKENS} AS ws FROM documents, crc),
  toks AS (SELECT doc_id, held_out, unnest(ws) AS w, unnest(list_prepend('  ', ws[:len(ws) - 1])) AS y FROM docs),
  raw AS (SELECT w, count(*) AS c FROM toks WHERE NOT held_out GROUP BY 1),
  size AS (SELECT coalesce(sum(c), 0)::BIGINT AS n, count(*) AS v FROM raw),
  bi AS (SELECT y, w, count(*) AS c FROM toks WHERE NOT held_out GROUP BY 1, 2),
  uni AS (SELECT w, count(*) AS c FROM bi GROUP BY 1),
  {_discount_sql('bi', 'b')},
  {_discount_sql('uni', 'u')},
  ctx AS (SELECT y, sum(c)::DOUBLE AS total, count(*) FILTER (WHERE c = 1) * any_value(d1) + count(*) FILTER (WHERE c = 2) * any_value(d2)
      + count(*) FILTER (WHERE c >= 3) * any_value(d3) AS lost FROM bi, b_d GROUP BY 1),
  one AS (SELECT sum(c)::DOUBLE AS total, count(*) FILTER (WHERE c = 1) * any_value(d1) + count(*) FILTER (WHERE c = 2) * any_value(d2)
      + count(*) FILTER (WHERE c >= 3) * any_value(d3) AS lost FROM uni, u_d),
  uni_p AS (SELECT w, (c - CASE c WHEN 1 THEN d1 WHEN 2 THEN d2 ELSE d3 END) / total AS p FROM uni, u_d, one),
  bi_p AS (SELECT y, w, (c - CASE c WHEN 1 THEN d1 WHEN 2 THEN d2 ELSE d3 END) / total AS p FROM bi JOIN ctx USING (y), b_d),
  scored AS (SELECT t.doc_id, t.held_out, r.c IS NOT NULL AS known, log10((coalesce(r.c, 0) + 0.5::DOUBLE) / (s.n + 0.5::DOUBLE * (s.v + 1))) AS base,
      log10(coalesce(b.p, 0) + coalesce(x.lost / x.total, 1) * (coalesce(u.p, 0) + coalesce(one.lost / one.total, 1) / (s.v + 1))) AS lp
    FROM toks t CROSS JOIN size s CROSS JOIN one LEFT JOIN raw r ON r.w = t.w LEFT JOIN uni_p u ON u.w = t.w
    LEFT JOIN ctx x ON x.y = t.y LEFT JOIN bi_p b ON b.y = t.y AND b.w = t.w)
  SELECT doc_id, held_out, count(*) AS n_tokens, count(*) FILTER (WHERE known) AS n_known, (SELECT n FROM size) AS train_tokens,
    round(fsum(base), 6) AS base_score, round(fsum(lp), 6) AS score FROM scored GROUP BY 1, 2"""
