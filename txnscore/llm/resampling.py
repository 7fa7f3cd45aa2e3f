"""Importance resampling towards a target distribution of hashed word runs.

Features are runs of 1 to ``longest`` consecutive words; a feature falls into the bucket crc32(bytes) modulo
``buckets``. A bucket's gain is the log ratio of its smoothed share in the target to that in the
corpus, a document's weight the sum over its features, and the Gumbel-perturbed weights of all
documents decide which are drawn, without replacement.

The distinct features of a slice are grouped by length into two-dimensional uint8 arrays; one
step of the CRC runs over a whole column of such an array, and the buckets are scattered back to the
features. Counting moves one row per bucket and task; the driver holds ``buckets`` numbers.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textbytes as tb
from .duck import CRC_CTE, crc32, lower_ascii
from .order import row_numbers
from .tables import cut

#: Fixed by the feature definition: bytes of words after lower-casing (0-9, a-z and all beyond ASCII).
IS_WORD = np.zeros(256, bool)
IS_WORD[ord("0"):ord("9") + 1] = True
IS_WORD[ord("a"):ord("z") + 1] = True
IS_WORD[128:] = True

#: Features with more bytes are hashed one by one, as a column step would serve very few of them.
LONGEST_COLUMN = 64


def _crc_table() -> np.ndarray:
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = np.where(value & np.uint32(1), (value >> np.uint32(1)) ^ np.uint32(0xEDB88320), value >> np.uint32(1))
    return value


_CRC = _crc_table()


def _distinct_rows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First positions and inverse of the distinct rows of a two-dimensional uint8 array."""
    n, length = rows.shape
    packed = np.zeros((n, -(-length // 8) * 8), np.uint8)
    packed[:, :length] = rows
    packed = packed.view(np.uint64)
    digest = packed[:, 0]
    for k in range(1, packed.shape[1]):
        digest = tb.mix(digest + np.uint64(k)) ^ packed[:, k]
    _, first, inverse = np.unique(digest, return_index=True, return_inverse=True)
    if packed.shape[1] > 1 and (packed[first[inverse]] != packed).any():  # two features with one digest
        _, first, inverse = np.unique(packed, axis=0, return_index=True, return_inverse=True)
    return first, inverse.reshape(-1)


def crc32_spans(buf: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """crc32 (uint32) of ``buf[begin:end]`` for every span."""
    length = end - begin
    out = np.zeros(len(begin), np.uint32)
    order = np.argsort(length, kind="stable")
    at = np.flatnonzero(np.diff(length[order], prepend=-1))
    for lo, hi in zip(at, np.append(at[1:], len(order))):
        spans = order[lo:hi]
        size = int(length[spans[0]])
        if size > LONGEST_COLUMN:
            out[spans] = [zlib.crc32(buf[a:b]) for a, b in zip(begin[spans], end[spans])]
            continue
        rows = buf[begin[spans][:, None] + np.arange(size)]
        first, inverse = _distinct_rows(rows) if size else (np.zeros(1, np.int64), np.zeros(len(spans), np.int64))
        rows = rows[first]
        crc = np.full(len(rows), 0xFFFFFFFF, np.uint32)
        for k in range(size):
            crc = _CRC[(crc ^ rows[:, k]) & np.uint32(0xFF)] ^ (crc >> np.uint32(8))
        out[spans] = (~crc)[inverse]
    return out


def features(s: tb.Slice, longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and text of every feature of a slice, and the number of words of each text."""
    lower = tb.LOWER[s.buf]
    is_word = IS_WORD[lower]
    start, end = tb.spans(is_word, s.offsets)
    doc = tb.owner(s.offsets, start)
    size = end - start
    # words one after another, each followed by one blank: every run is a span of this buffer
    begin = tb.bounds(size + 1)[:-1]
    joined = np.full(int((size + 1).sum()), 0x20, np.uint8)
    joined[np.arange(int(size.sum())) + np.repeat(np.arange(len(size)), size)] = lower[is_word]
    bucket, of = [], []
    for n in range(1, longest + 1):
        first = np.flatnonzero(doc[:len(doc) - n + 1] == doc[n - 1:]) if len(doc) >= n else np.zeros(0, np.int64)
        bucket.append(crc32_spans(joined, begin[first], (begin + size)[first + n - 1]).astype(np.int64) % buckets)
        of.append(doc[first])
    return np.concatenate(bucket), np.concatenate(of), tb.counts(doc, s.n)


def bucket_counts(texts: DataFrame, longest: int, buckets: int) -> np.ndarray:
    """How many features of the one text column of ``texts`` fall into each bucket."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for s in tb.slices(batch.column(0)):
                total += np.bincount(features(s, longest, buckets)[0], minlength=buckets)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(total[found])], names=["bucket", "n"])

    rows = texts.mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(buckets, np.int64)
    out[rows["bucket"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))) per bucket, in doubles."""
    n = len(source)
    up = (target + 1).astype(float) * float(source.sum() + n)
    down = (source + 1).astype(float) * float(target.sum() + n)
    return np.floor(1000.0 * np.log(up / down)).astype(np.int64)


def weights(docs: DataFrame, gain: np.ndarray, longest: int) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of (doc_id, text); the id keeps its type."""

    def run(batches):
        for batch in batches:
            for s in tb.slices(batch.column(1)):
                bucket, doc, n_words = features(s, longest, len(gain))
                # sums of whole numbers far below 2^53
                weight = np.bincount(doc, gain[bucket].astype(float), minlength=s.n).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(s.first, s.n), pa.array(n_words), pa.array(tb.counts(doc, s.n)), pa.array(weight)],
                    names=["doc_id", "n_words", "n_features", "weight"])

    long = T.LongType()
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType)]
                          + [T.StructField(c, long) for c in ("n_words", "n_features", "weight")])
    return docs.mapInArrow(run, schema)


def resample(docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = 10_000, percent: int = 10,
             min_words: int = 20, seed: int = 2024) -> DataFrame:
    """Draw ``percent`` of the documents with at least ``min_words`` words towards ``target`` (text).

    One row per input row: doc_id, n_features, weight, score, rank (1, 2, ... for the drawn ones,
    else null). The noise is a hash of ``seed`` and the id, so reruns agree. Null and empty texts have no
    words, no features and weight 0. A null id counts as the empty text in the hash and stands last
    among equal scores; repeated rows are documents of their own, with equal scores and
    consecutive ranks. An empty target gives every bucket its smoothing count only, an empty corpus no rows.
    Ids may be of any type that can be sorted and cast to text; other columns are ignored.
    """
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    gain = gains(bucket_counts(docs.select("text"), longest, buckets),
                 bucket_counts(target.select(F.col("text").cast("string").alias("text")), longest, buckets))
    noise = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8),
                   16, 10).cast("double")
    gumbel = F.floor(-1000.0 * F.log(-F.log((noise + 0.5) / 4294967296.0)))
    scored = cut(weights(docs, gain, longest).withColumn("score", (F.col("weight") + gumbel).cast("long")))
    fit = scored.filter(F.col("n_words") >= min_words)
    n_drawn = percent * fit.count() // 100
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("weight")]
    drawn = row_numbers(fit, order, "rank").withColumn("rank", F.when(F.col("rank") <= n_drawn, F.col("rank")))
    columns = ["doc_id", "n_features", "weight", "score"]
    return drawn.select(*columns, "rank").union(
        scored.filter(F.col("n_words") < min_words).select(*columns, F.lit(None).cast("long").alias("rank")))


_WORDS = rf"regexp_extract_all({lower_ascii("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE_SQL = rf"""WITH {CRC_CTE},
  words AS (SELECT 0 AS side, doc_id, unnest({_WORDS}) AS w FROM documents
    UNION ALL SELECT 1, item_id, unnest({_WORDS}) FROM benchmark),
  hashed AS (SELECT w, {crc32('w')} % 10000 AS bucket FROM (SELECT DISTINCT w FROM words), crc),
  per AS (SELECT b AS bucket, coalesce(s, 0) AS s, coalesce(t, 0) AS t FROM range(10000) r(b) LEFT JOIN
    (SELECT bucket, count(*) FILTER (WHERE side = 0) AS s, count(*) FILTER (WHERE side = 1) AS t
     FROM words JOIN hashed USING (w) GROUP BY 1) ON b = bucket),
  gain AS (SELECT bucket, floor(1000.0::DOUBLE * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM per) + 10000)::DOUBLE
      / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM per) + 10000)::DOUBLE)))::BIGINT AS gain FROM per),
  weighed AS (SELECT doc_id, count(*) AS n, sum(gain)::BIGINT AS weight
    FROM words JOIN hashed USING (w) JOIN gain USING (bucket) WHERE side = 0 GROUP BY 1),
  scored AS (SELECT d.doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
      + floor(-1000.0::DOUBLE * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE)
          / 4294967296.0::DOUBLE)))::BIGINT AS score
    FROM documents d LEFT JOIN weighed USING (doc_id)),
  ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n_fit
    FROM scored WHERE n_features >= 20)
  SELECT doc_id, n_features, weight, score, CASE WHEN r <= 10 * n_fit // 100 THEN r END AS rank
  FROM scored LEFT JOIN ranked USING (doc_id)"""
