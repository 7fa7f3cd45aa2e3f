"""Language identification with bit-sliced Bloom filters of byte n-grams.

Every language has a Bloom filter of its frequent 4-byte n-grams; the filters of up to 64 languages lie
side by side, one bit of a 64-bit word per language, so that the AND of a few slots gives the
bitmask of all of them that contain an n-gram. More languages take more words. A text's n-grams add up to
one count per language; each is corrected for the language's false-positive rate, and the largest share decides.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textbytes as tb
from .graph import checked
from .tables import cut, discard, fold

#: Training documents per language (a documented bound of the fit), n-grams per language (the size of a filter), slots.
SAMPLE_DOCS, TOP_NGRAMS, SLOTS, PROBES = 2_000, 30_000, 1 << 19, 3
#: Languages of one word, and words (4 MB each) that one pass over the texts broadcasts.
WORD, WORDS_PER_PASS = 64, 16

_LETTER = np.zeros(256, bool)
_LETTER[ord("a"):ord("z") + 1] = True
_LETTER[128:] = True


def _normal(s: tb.Slice) -> np.ndarray:
    """Bytes with letters in lower case (ASCII, and the letters that UTF-8 writes as C3 80 .. C3 9E)
    and everything else in ASCII as blanks."""
    buf = tb.LOWER[s.buf]
    if len(buf) > 1:
        accented = (buf[:-1] == 0xC3) & (buf[1:] >= 0x80) & (buf[1:] <= 0x9E) & (buf[1:] != 0x97)
        buf[1:][accented] += 0x20
    return np.where(_LETTER[buf], buf, np.uint8(0x20))


def _ngrams(s: tb.Slice):
    """The 4-byte n-grams with two letters or more, as 32-bit numbers, and their text."""
    buf = _normal(s).astype(np.uint32)
    if len(buf) < 4:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    key = buf[:-3] | buf[1:-2] << 8 | buf[2:-1] << 16 | buf[3:] << 24
    letters = tb.bounds(buf != 0x20)
    pos = np.arange(len(key))
    text = np.repeat(np.arange(s.n), np.diff(s.offsets))[:len(key)]
    ok = (pos + 4 <= s.offsets[text + 1]) & (letters[4:] - letters[:-4] >= 2)
    return key[ok], text[ok]


def _slots(keys: np.ndarray):
    h = tb.mix(keys.astype(np.uint64) + np.uint64(0x5851F42D4C957F2D))
    for k in range(PROBES):
        yield ((h >> np.uint64(20 * k)) & np.uint64(SLOTS - 1)).astype(np.int64)


def bloom(keys: np.ndarray) -> bytes:
    """One language's Bloom filter: SLOTS bits, packed."""
    bits = np.zeros(SLOTS, bool)
    for slot in _slots(keys):
        bits[slot] = True
    return np.packbits(bits).tobytes()


class Filters:
    """Bit-sliced Bloom filters, ``WORD`` languages to a word of 64 bits, and their false-positive rates."""

    def __init__(self, languages: list[str], filters: list[bytes]):
        self.languages = languages
        self.words = np.zeros((-(-len(languages) // WORD), SLOTS), np.uint64)
        self.false_rate = np.zeros(len(languages))
        for i, packed in enumerate(filters):
            bits = np.unpackbits(np.frombuffer(packed, np.uint8))
            self.words[i // WORD] |= bits.astype(np.uint64) << np.uint64(i % WORD)
            self.false_rate[i] = bits.mean() ** PROBES

    def passes(self) -> list[Filters]:
        """The same filters in parts of bounded size."""
        step, out = WORD * WORDS_PER_PASS, []
        for first in range(0, len(self.languages), step):
            part = Filters(self.languages[first:first + step], [])
            part.words = self.words[first // WORD:first // WORD + WORDS_PER_PASS]
            part.false_rate = self.false_rate[first:first + step]
            out.append(part)
        return out

    def shares(self, s: tb.Slice) -> np.ndarray:
        """Corrected share of each text's n-grams that each language contains (n x languages)."""
        keys, text = _ngrams(s)
        n = np.bincount(text, minlength=s.n)
        at = tb.bounds(n)
        out = np.zeros((s.n, len(self.languages)))
        slots = list(_slots(keys))
        for w, bits in enumerate(self.words):
            mask = bits[slots[0]]
            for slot in slots[1:]:
                mask &= bits[slot]
            for i in range(w * WORD, min((w + 1) * WORD, len(self.languages))):
                hit = tb.group_reduce(np.add, ((mask >> np.uint64(i % WORD)) & np.uint64(1)).astype(np.int64), at, 0)
                false = self.false_rate[i]
                out[:, i] = np.maximum(hit - false * n, 0) / np.maximum((1 - false) * n, 1)
        return out


def _top_ngrams(counted: DataFrame) -> DataFrame:
    """Of each language (lang, key, n) about ``TOP_NGRAMS`` most frequent keys: whole levels of n from the highest down, and
    of the first level that does not fit whole, the share that does, drawn by the keys' hashes.

    The levels come from partially aggregated counts, so no task sorts the n-grams of a language.
    """
    levels = counted.groupBy("lang", "n").agg(F.count(F.lit(1)).alias("keys"))
    above = F.sum("keys").over(Window.partitionBy("lang").orderBy(F.desc("n"))) - F.col("keys")
    edge = (levels.withColumn("share", (F.lit(TOP_NGRAMS) - above) / F.col("keys")).filter("share > 0")
            .groupBy("lang").agg(F.min("n").alias("edge"), F.min_by("share", "n").alias("share")))
    draw = F.pmod(F.xxhash64("key"), F.lit(1 << 30)) / float(1 << 30)
    return (counted.join(edge, "lang").filter((F.col("n") > F.col("edge")) | ((F.col("n") == F.col("edge")) & (draw < F.col("share"))))
            .select("lang", "key"))


def train(docs: DataFrame) -> Filters:
    """Filters of every language of the (text, lang) of ``docs``: of each, the documents with the smallest
    hashes, about ``SAMPLE_DOCS``, count their n-grams. 64 KB per language reach the driver."""
    known = (docs.filter("lang is not null and text is not null")
             .select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
             .withColumn("k", F.xxhash64("lang")))
    sizes = cut(known.groupBy("k", "lang").agg(F.count(F.lit(1)).alias("n_docs")))
    names = sorted(r["lang"] for r in sizes.toLocalIterator())
    few = sizes.groupBy("k").agg(F.sum("n_docs").alias("n_docs"))
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 30)) / float(1 << 30)
    sample = (known.join(checked(sizes, few, columns=2), "k").filter(F.coalesce(draw, F.lit(0.0)) * F.col("n_docs") < SAMPLE_DOCS)
              .select("lang", "text"))

    def count(batches):
        for batch in batches:
            names, langs = np.unique(batch.column(0).to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
            for s in tb.slices(batch.column(1)):
                keys, text = _ngrams(s)
                tagged, n = np.unique(langs[s.first + text].astype(np.uint64) << np.uint64(32) | keys, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(names[(tagged >> np.uint64(32)).astype(np.int64)], pa.string()),
                                                  pa.array((tagged & np.uint64(0xFFFFFFFF)).astype(np.int64)), pa.array(n)],
                                                 names=["lang", "key", "n"])

    def pack(rows: pa.Table) -> pa.Table:  # about TOP_NGRAMS numbers
        keys = rows.column("key").to_numpy().astype(np.uint32)
        return pa.table({"lang": rows.column("lang")[:1].cast(pa.string()), "bits": pa.array([bloom(keys)], pa.binary())})

    counted = cut(sample.mapInArrow(count, "lang string, key long, n long").groupBy("lang", "key").agg(F.sum("n").alias("n")))
    packed = _top_ngrams(counted).groupBy("lang").applyInArrow(pack, "lang string, bits binary")
    filters = {r["lang"]: bytes(r["bits"]) for r in packed.toLocalIterator()}
    discard(counted)
    discard(sizes)
    return Filters(names, [filters.get(name, bloom(np.zeros(0, np.uint32))) for name in names])


def predict(docs: DataFrame, filters: Filters) -> DataFrame:
    """doc_id, lang_pred and score of every row; ``und`` (score 0) without a letter.

    A pass over the texts broadcasts at most ``WORDS_PER_PASS`` words (64 MB for 1 024 languages); each further
    1 024 languages take a pass of their own, which goes on from the best language so far and the sum of shares.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.col("text").cast("string")
    state = (docs.select("doc_id", text.alias("text"), F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("lettered"))
             .withColumns({"lang_pred": F.lit("und"), "best": F.lit(-1.0), "total": F.lit(0.0)}))

    def judged_by(shared, columns):
        def run(batches):
            model = shared.value
            names = np.array(model.languages, object)
            for batch in batches:
                lettered = batch.column("lettered").to_numpy(zero_copy_only=False).astype(bool)
                for s in tb.slices(batch.column("text")):
                    own = batch.slice(s.first, s.n)
                    share = model.shares(s)
                    best, total = own.column("best").to_numpy(), own.column("total").to_numpy()
                    # a text with letters always gets a learned language, if there is one
                    better = lettered[s.first:s.first + s.n] & (share.max(axis=1) > best)
                    pred = np.where(better, names[share.argmax(axis=1)], own.column("lang_pred").to_numpy(zero_copy_only=False))
                    out = {"doc_id": own.column("doc_id"), "text": own.column("text"), "lettered": own.column("lettered"),
                           "lang_pred": pa.array(pred, pa.string()), "best": pa.array(np.where(better, share.max(axis=1), best)),
                           "total": pa.array(total + share.sum(axis=1))}
                    yield pa.RecordBatch.from_pydict({c: out[c] for c in columns})
        return run

    schema = {"doc_id": kind, "lettered": "boolean", "lang_pred": "string", "best": "double", "total": "double"}
    parts = filters.passes()
    for i, part in enumerate(parts):
        kept = schema if i == len(parts) - 1 else {**schema, "text": "string"}  # the last pass leaves the text behind
        state = state.mapInArrow(judged_by(spark.sparkContext.broadcast(part), list(kept)), ", ".join(f"{c} {t}" for c, t in kept.items()))
    score = F.when(F.col("total") > 0, F.greatest("best", F.lit(0.0)) / F.col("total")).otherwise(0.0)
    return state.select("doc_id", "lang_pred", F.when(F.col("lettered"), score).otherwise(0.0).alias("score"))


def identify(docs: DataFrame, folds: int = 5) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, lang): doc_id, held_out, lang_pred, score.

    Rows with crc32 of the id's text modulo ``folds`` of 0 are held out of the fit, as are rows with a null
    lang or text; lang and doc_id are no inputs of a prediction. Null texts, and texts without a letter,
    get ``und`` with score 0, as does everything when no language was learned. Ties go to the language
    that is first by code point. Ids may be null (the id's text is then empty) or repeated; an empty
    table gives no rows.
    """
    filters = train(docs.filter(fold(F.col("doc_id"), folds) != 0))
    return predict(docs, filters).select("doc_id", (fold(F.col("doc_id"), folds) == 0).alias("held_out"), "lang_pred", "score")
