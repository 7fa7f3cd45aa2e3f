"""Benchmark decontamination on templates.

Words lose punctuation and A-Z case and are read in three ways: as they are; with typed placeholders
for numbers, names (capitalized inside a sentence; neighbouring ones are one) and units; and with
placeholders also for capitalized words that open a sentence. What a word is depends on its own
window only, so a passage has the same windows in whatever text it stands, and a literal copy
always has the item's literal windows. Windows of ``window`` words are hashed on both sides,
and for shorter items windows of their own length. The hashes of the benchmark go to the tasks in bounded slices, so that only windows that
occur in it leave the scan of the documents; these are hash-joined to the benchmark's windows.

A copy of an item in a document keeps one distance between the two positions; along one distance,
a slot value of the item should always meet the same value in the document and the reverse, as in a
re-parameterised question. Only the windows that hold another pair than the most frequent one do
not count; windows with equal values always do. A document is contaminated by an item if they cover
half of the item's windows, or ``run`` windows (13 words for 6 windows of 8): counted by the literal
windows at whose places any of the three is found, or by those with placeholders.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .graph import checked
from .tables import cut

#: Benchmark window hashes sent to the tasks at once (8 MB); more of them take more scans.
HASHES_PER_SCAN = 1 << 20

#: First bits by which a window's hash is looked up before the whole one is, and bytes of text per numpy pass:
#: small enough for a core's cache.
HEAD_BITS, PIECE_BYTES = 18, 1 << 18

#: Units of measure and currency that become one placeholder.
UNITS = ("mm cm m km g kg mg lb lbs oz ml l ft feet foot inch inches mile miles meter meters metre metres kilometer kilometers "
         "kilometre kilometres gram grams kilogram kilograms pound pounds ounce ounces liter liters litre litres second seconds "
         "minute minutes hour hours day days week weeks month months year years mph kmh percent dollar dollars euro euros cent "
         "cents usd eur gbp").split()

_NUMBER, _NAME, _UNIT = 1, 2, 3
_UPPER = np.zeros(256, bool)
_UPPER[ord("A"):ord("Z") + 1] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[ord("0"):ord("9") + 1] = True
_KEPT = _DIGIT.copy()
_KEPT[ord("a"):ord("z") + 1] = True
_KEPT |= _UPPER
_KEPT[128:] = True
_END = np.zeros(256, bool)
_END[[ord(c) for c in ".!?:"]] = True
_SKIPPED = tb.IS_SPACE.copy()
_SKIPPED[[ord(c) for c in "\"'()[]{}<>*_`"]] = True


@cache
def _unit_hashes() -> np.ndarray:
    data = np.frombuffer("".join(UNITS).encode(), np.uint8)
    at = tb.bounds(np.array([len(u) for u in UNITS]))
    return np.sort(tb.span_hash(tb.prefix_hash(data), at[:-1], at[1:]))


def _between_sentences(buf: np.ndarray) -> np.ndarray:
    """White space, quotes and brackets: they may stand between a sentence's mark and the next one."""
    skip = _SKIPPED[buf]
    two = (buf[:-1] == 0xC2) & ((buf[1:] == 0xAB) | (buf[1:] == 0xBB))
    last = buf[2:]
    three = (buf[:-2] == 0xE2) & (buf[1:-1] == 0x80) & (((last >= 0x98) & (last <= 0x9F)) | (last == 0xB9) | (last == 0xBA))
    for found, width in ((two, 2), (three, 3)):
        at = np.flatnonzero(found)
        for k in range(width):
            skip[at + k] = True
    return skip


@dataclass
class Tokens:
    """Words of a slice in one reading: hash of the word or placeholder, slot type (0 for a plain
    word) and value, text, and number among the text's words; ``as_first`` is the slot type at the
    start of a window, ``opener`` marks what only this reading takes for a name."""

    word: np.ndarray
    kind: np.ndarray
    value: np.ndarray
    doc: np.ndarray
    number: np.ndarray
    as_first: np.ndarray
    opener: np.ndarray


def readings(s: tb.Slice) -> list[Tokens]:
    """The words of a slice as they are; with placeholders; and with placeholders also for
    capitalized words that open a sentence.

    What a word is depends on the word and on what stands between it and the one before. The first
    word of a window counts as one that opens a sentence, whatever stands before the window.
    """
    start, end, doc = tb.words(s)
    kept = _KEPT[s.buf]
    at = tb.bounds(kept)
    lo, hi = at[start], at[end]
    core = tb.LOWER[s.buf][kept]
    value = tb.span_hash(tb.prefix_hash(core), lo, hi)
    digits = tb.bounds(_DIGIT[s.buf])
    raw = s.buf[kept]
    # upper-case letters outside ASCII that UTF-8 writes as C3 80 .. C3 9E count as capitals too
    first = raw[np.minimum(lo, max(len(raw) - 1, 0))] if len(raw) else np.zeros(len(lo), np.uint8)
    second = raw[np.minimum(lo + 1, max(len(raw) - 1, 0))] if len(raw) else first
    accented = (first == 0xC3) & (second >= 0x80) & (second <= 0x9E)
    wide = np.where(accented, 2, 1)
    following = raw[np.minimum(lo + wide, max(len(raw) - 1, 0))] if len(raw) else first
    solid = hi > lo
    capital = (_UPPER[first] | accented) & ~((hi - lo > wide) & (_UPPER[following] | (following == 0xC3))) & solid
    newlines = tb.bounds(s.buf == 0x0A)
    # the last byte before each word that is no space, quote or bracket
    before = np.append(-1, np.maximum.accumulate(np.where(_between_sentences(s.buf), -1, np.arange(len(s.buf)))))[start]
    opens = (before < s.offsets[doc]) | _END[s.buf[np.maximum(before, 0)]]
    opens[1:] |= newlines[start[1:]] > newlines[end[:-1]]
    units = _unit_hashes()
    fixed = np.where(units[np.minimum(np.searchsorted(units, value), len(units) - 1)] == value, _UNIT, 0)
    fixed[digits[end] > digits[start]] = _NUMBER
    numbers = tb.bounds(solid)
    number = numbers[:-1] - numbers[np.searchsorted(doc, doc)]
    none = np.zeros(len(start), np.int64)
    out = [Tokens(value[solid], none[solid], value[solid], doc[solid], number[solid], none[solid], none[solid])]
    for names, opening in ((capital & ~opens, 0), (capital, _NAME)):
        kind = np.where((fixed == 0) & names, _NAME, fixed)
        as_first = np.where((fixed == 0) & capital, opening, fixed)
        # what this reading takes for a name only because it opens a sentence
        opener = (kind == _NAME) & opens
        follows = np.zeros(len(start), bool)
        follows[1:] = (kind[1:] == _NAME) & (kind[:-1] == _NAME) & (doc[1:] == doc[:-1]) & ~opens[1:]
        use = solid & ~follows
        out.append(Tokens(np.where(kind > 0, kind.astype(np.uint64), value)[use], kind[use], value[use], doc[use],
                          number[use], as_first[use], opener[use].astype(np.int64)))
    return out


def windows(t: Tokens, reading: int, length: int):
    """(first word, hash, plain words) of every window of ``length`` words inside a text. The third
    reading gives only windows that differ from the second one."""
    m = len(t.word) - length + 1
    if m <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    inside = t.doc[:m] == t.doc[length - 1:]
    if reading == 2:
        openers = tb.bounds(t.opener)
        inside &= (t.as_first[:m] == _NAME) | (openers[length:] > openers[1:m + 1])
    head = np.where(t.as_first[:m] > 0, t.as_first[:m].astype(np.uint64), t.value[:m])
    h = tb.mix(head + np.uint64((reading * 64 + length) * 0x9E3779B97F4A7C15 % (1 << 64)))
    for k in range(1, length):
        h *= np.uint64(0x9E3779B97F4A7C15)
        h += t.word[k:k + m]
        h = tb.mix(h)
    slots = tb.bounds(t.kind > 0)
    plain = length - (t.as_first[:m] > 0) - (slots[length:] - slots[1:m + 1])
    first = np.flatnonzero(inside)
    return first, h[first], plain[first]


def text_windows(s: tb.Slice, size: int, lengths: list[int] | None = None):
    """Per reading (tokens, first word, hash, length) of the windows of a text that are searched.

    Without ``lengths`` the windows of an item: those of ``size`` words, or the one of its own length
    if it is shorter. With ``lengths`` a document's windows of each of these lengths. A window with
    placeholders needs ``size / 2`` plain words; shorter ones, if half of them are plain, equal a
    text that consists of nothing else. The literal reading holds every window.
    """
    for reading, t in enumerate(readings(s)):
        n = tb.counts(t.doc, s.n)
        parts = [(np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))]
        for length in range(1, size + 1):
            own = length < size and (n == length).any()
            inner = own or length == size if lengths is None else length in lengths
            if not (own or inner):
                continue
            first, h, plain = windows(t, reading, length)
            whole = n[t.doc[first]] == length
            fits = 2 * plain >= size if reading else np.ones(len(first), bool)
            if length < size and lengths is None:
                fits &= whole
            if inner:
                parts.append((first[fits], h[fits], np.full(int(fits.sum()), length)))
            if own and reading:
                alone = whole & (2 * plain >= length)
                parts.append((first[alone], tb.mix(h[alone] + np.uint64(1)), np.full(int(alone.sum()), length)))
        yield (t, *(np.concatenate(x) for x in zip(*parts)))


def _slots(t: Tokens, first: np.ndarray, length: np.ndarray) -> list:
    """Per window the hashes of type and value of its slots in order."""
    def of(kind, value):
        return tb.mix(value * np.uint64(5) + kind.astype(np.uint64)).view(np.int64)

    inner, head = of(t.kind, t.value), of(t.as_first, t.value)
    return [([int(head[a])] if t.as_first[a] else []) + inner[a + 1:b][t.kind[a + 1:b] > 0].tolist() for a, b in zip(first, first + length)]


def _positions(t: Tokens, first: np.ndarray, n: int) -> np.ndarray:
    return first - tb.bounds(tb.counts(t.doc, n))[t.doc[first]]


def item_windows(items: DataFrame, size: int) -> DataFrame:
    """(id, h, reading, length, pos, slots, place, template) of the windows of (id, text). ``place`` is the hash of
    the literal window that starts at the same word, ``template`` that of the window with
    placeholders there (null for literal windows)."""

    def run(batches):
        for batch in batches:
            for s in tb.slices(batch.column(1)):
                place = template = None
                for reading, (t, first, h, length) in enumerate(text_windows(s, size)):
                    if reading == 0:
                        begin = tb.bounds(tb.counts(t.doc, s.n))
                        place, template = np.zeros((2, len(t.word)), np.uint64)
                        place[first] = h
                    word = begin[t.doc[first]] + t.number[first]
                    if reading == 1:
                        template[word] = h
                    of_word = np.where(template[word] == 0, h, template[word]).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(s.first, s.n).take(pa.array(t.doc[first])), pa.array(h.view(np.int64)),
                         pa.array(np.full(len(h), reading, np.int32)), pa.array(length.astype(np.int32)), pa.array(_positions(t, first, s.n).astype(np.int32)),
                         pa.array(_slots(t, first, length), pa.list_(pa.int64())), pa.array(place[word].view(np.int64)),
                         pa.array(of_word, mask=np.full(len(h), reading == 0))],
                        names=["id", "h", "reading", "length", "pos", "slots", "place", "template"])

    return items.mapInArrow(run, "id long, h long, reading int, length int, pos int, slots array<bigint>, place long, template long")


def found_windows(docs: DataFrame, size: int, lengths: list[int], wanted: np.ndarray) -> DataFrame:
    """(id, h, pos, slots) of those windows of (id, text) whose hash is in ``wanted`` (sorted).

    ``slots`` holds, per slot of the window in order, the hash of its type and value.
    """

    def run(batches):
        # most windows already differ from all wanted ones in their first bits
        head = np.uint64(64 - HEAD_BITS)
        heads = np.zeros(1 << HEAD_BITS, bool)
        heads[wanted >> head] = True
        for batch in batches:
            for s in tb.slices(batch.column(1), PIECE_BYTES):
                for t, first, h, length in text_windows(s, size, lengths):
                    near = np.flatnonzero(heads[h >> head])
                    near = near[wanted[np.minimum(np.searchsorted(wanted, h[near]), len(wanted) - 1)] == h[near]] if len(wanted) else near
                    first, h, length = first[near], h[near], length[near]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(s.first, s.n).take(pa.array(t.doc[first])), pa.array(h.view(np.int64)),
                         pa.array(_positions(t, first, s.n).astype(np.int32)), pa.array(_slots(t, first, length), pa.list_(pa.int64()))],
                        names=["id", "h", "pos", "slots"])

    return docs.mapInArrow(run, "id long, h long, pos int, slots array<bigint>")


def _consistent(batches):
    """(doc_id, item_id, reading, place, template, changed) of the windows along one distance that count.

    Every slot value keeps the partner that it meets in most windows, one to one; windows with
    another pair go, unless all their values are equal on both sides.
    """
    for batch in batches:
        out = []
        for doc, item, reading, met in zip(*(c.to_pylist() for c in batch.columns)):
            pairs = [[(p["theirs"], p["ours"]) for p in w["pairs"]] for w in met]
            theirs, ours = {}, {}
            often = Counter(p for of in pairs for p in set(of))
            for x, y in sorted(often, key=lambda p: (-often[p], p[0] != p[1], p)):
                if x not in theirs and y not in ours:
                    theirs[x], ours[y] = y, x
            good = [k for k, of in enumerate(pairs) if all(x == y for x, y in of) or all(theirs.get(x) == y for x, y in of)]
            changed = len({p for k in good for p in pairs[k] if p[0] != p[1]})
            out += [(doc, item, reading, met[k]["place"], met[k]["template"], changed) for k in good]
        names = ["doc_id", "item_id", "reading", "place", "template", "changed"]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(6)], names=names)


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 8, run: int = 6, percent: int = 50, least: int = 4) -> DataFrame:
    """Pairs (doc_id, item_id, n_windows, n_matched, n_changed, n_literal, by_template, weak) of contaminated documents.

    ``n_windows`` counts the item's distinct windows (literal ones, or those with placeholders where only these are
    enough), ``n_matched`` those found on consistent distances, ``n_changed`` the most slot values that differ along one distance.
    ``n_literal`` counts the windows that are found word for word, an addition to the templates; ``by_template`` says whether the
    windows with placeholders are enough by themselves. ``weak`` marks items of fewer than ``least`` words, which
    are reported but are no evidence: any text about their subject may hold them. Null and empty
    texts, and rows with a null doc_id or item_id, give no pair; repeated rows give one pair; an
    empty table on either side gives no rows; other columns are ignored.
    """
    items = (benchmark.select(F.col("item_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
             .filter("id is not null and text is not null"))
    theirs = cut(item_windows(items, window).distinct())
    lengths = sorted(r["length"] for r in theirs.select("length").distinct().collect())
    docs = (docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
            .filter("id is not null and text is not null"))
    # the benchmark's hashes in slices by value: every slice is bounded, together they are whole
    hashes = theirs.select("h").distinct()
    n_slices = -(-hashes.count() // HASHES_PER_SCAN)
    found = None
    for k in range(n_slices):
        part = hashes.filter(F.pmod(F.xxhash64("h"), F.lit(n_slices)) == k).toPandas()["h"].to_numpy(np.int64)
        hits = found_windows(docs, window, lengths, np.sort(part.view(np.uint64)))
        found = hits if found is None else found.union(hits)
    if found is None:
        found = found_windows(docs, window, lengths, np.zeros(0, np.uint64))
    sizes = theirs.groupBy("id").agg(F.count_distinct("place").alias("n_places"), F.count_distinct("template").alias("n_templates"),
                                     (F.max("length") < least).alias("weak")).withColumnRenamed("id", "item_id")
    met = (found.distinct().withColumnRenamed("id", "doc_id").withColumnRenamed("pos", "doc_pos").withColumnRenamed("slots", "doc_slots")
           .join(theirs.withColumnRenamed("id", "item_id"), "h")
           .withColumn("shift", F.col("doc_pos") - F.col("pos")))
    copies = met.groupBy("doc_id", "item_id", "reading", "shift").agg(F.collect_list(F.struct(
        "place", "template", F.arrays_zip(F.col("slots").alias("theirs"), F.col("doc_slots").alias("ours")).alias("pairs"))).alias("windows"))
    whole = (copies.select("doc_id", "item_id", "reading", "windows")
             .mapInArrow(_consistent, "doc_id long, item_id long, reading long, place long, template long, changed long")
             .groupBy("doc_id", "item_id").agg(F.count_distinct("place").alias("places"), F.count_distinct("template").alias("templates"),
                                               F.max("changed").alias("n_changed"),
                                               F.count_distinct(F.when(F.col("reading") == 0, F.col("place"))).alias("n_literal")))
    out = whole.join(sizes, "item_id")
    enough = lambda found, of: (100 * F.col(found) >= percent * F.col(of)) & (F.col(of) > 0) | (F.col(found) >= run)
    by_place = enough("places", "n_places")
    return out.filter(by_place | enough("templates", "n_templates")).select(
        "doc_id", "item_id", F.when(by_place, F.col("n_places")).otherwise(F.col("n_templates")).alias("n_windows"),
        F.when(by_place, F.col("places")).otherwise(F.col("templates")).alias("n_matched"), "n_changed",
        "n_literal", enough("templates", "n_templates").alias("by_template"), "weak")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the contaminated documents; rows with a null doc_id stay, and a
    weak item (see ``contaminated``) removes nothing."""
    gone = cut(contaminated(docs, benchmark, **options).filter("not weak").select(F.col("doc_id").alias("__gone")).distinct())
    return docs.join(checked(gone), F.col("doc_id").cast("long") == F.col("__gone"), "left_anti")
