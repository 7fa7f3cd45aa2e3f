"""Fuzzy line dedup: MinHash over character shingles, exact Jaccard check, union-find, one line kept.

A line is a ``\\n``-separated piece with at least one word; it is compared with A-Z lower-cased,
runs of white space as one blank and none at its ends. Equal lines are one node (64-bit hash), and only
distinct lines are compared. The sets are character shingles, of 5 characters for lines of at most 100 characters
and of 8 for lines of more than 80 (in between, either may link), so that a line of 49 characters or
more still links after one changed character. The nodes' one-permutation MinHash signatures
(``bands * rows`` bins, empty bins filled from bins chosen by a fixed probe sequence) are banded; a pair of
similarity 0.8 shares a band of 12 x 4 with probability 0.998, one of 0.85 with 0.9999. The bands' buckets are
formed in numpy on compressed blocks, one per shard of the keys (see ``bucket_members``).
Candidates are checked by their exact Jaccard similarity, first against the head of each bucket,
then, in buckets that still hold several components, against the most central line of the largest one, last
between the remaining components under an exact bound (``line_maps``). Components come from distributed union-find; of a component's occurrences the one with the
smallest (doc_id, line number) stays.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .blocks import bits_for, cuts, pack, shard_of, unpack
from .graph import MAX_BROADCAST_VALUES, checked, components
from .tables import cut, discard

#: Bytes of text per numpy pass: small enough for the arrays of a pass to stay in a core's cache.
PIECE_BYTES = 1 << 17

#: Shingle size, and the lengths of the lines that are compared by it (more than, at most): with 8 characters a line
#: of 81 still links after one changed character, with 5 one of 49.
FAMILIES = ((5, 0, 100), (8, 80, 1 << 60))

#: Band keys per shard, band keys that a task holds, and rows that it passes on in one block.
SHARD, HELD, PASSED = 1 << 21, 1 << 20, 1 << 16

#: Lines with more uses than this meet their occurrences apart from the others.
MANY_USES = 10_000

#: Bytes of lines that may be broadcast to the pairs that hold them.
BROADCAST_BYTES = 1 << 24

#: In buckets of more lines than this the lines first meet the most central one of the largest component.
FEW = 8

#: Bits of the map of a line's shingles (16 longs): the differing bits of two maps bound the shingles of only one line.
MAP_BITS = 1 << 10

#: Bytes with A-Z lower-cased and white space as a blank.
_NORMAL = np.where(tb.IS_SPACE, np.uint8(0x20), tb.LOWER)


def _lines(s: tb.Slice):
    """Normalized bytes of a slice, the spans of its lines in them, their text and line number."""
    space = tb.IS_SPACE[s.buf]
    newline = np.flatnonzero(s.buf == 0x0A)
    word_start, word_end = tb.spans(~space, s.offsets)
    # the first word at or after the start of a line or text
    first = np.zeros(len(word_start) + 1, bool)
    first[np.searchsorted(word_start, s.offsets[:-1])] = True
    first[np.searchsorted(word_start, newline + 1)] = True
    first = first[:-1]
    keep = ~space
    keep[word_start[~first] - 1] = True
    buf = _NORMAL[s.buf[keep]]
    opening = np.flatnonzero(first)
    begin = tb.bounds(word_end - word_start + ~first)[opening]
    end = np.append(begin[1:], len(buf)) if len(begin) else begin
    doc = tb.owner(s.offsets, word_start[opening])
    number = np.searchsorted(newline, word_start[opening]) - np.searchsorted(newline, s.offsets[doc])
    return buf, begin, end, doc, number


#: Fixed random 64-bit value of a byte by its place in its UTF-8 character.
_CHAR_VALUES = np.random.RandomState(4).randint(1, 1 << 62, (4, 256), dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def _char_values(buf: np.ndarray, chars: np.ndarray) -> np.ndarray:
    """One 64-bit value per UTF-8 character, given the positions of the characters' first bytes."""
    value = _CHAR_VALUES[0][buf[chars]]
    if len(chars) < len(buf):
        length = np.diff(np.append(chars, len(buf)))
        for k in range(1, 4):
            longer = np.flatnonzero(length > k)
            value[longer] = tb.mix(value[longer] + _CHAR_VALUES[k][buf[chars[longer] + k]])
    return value


def _shingles(buf: np.ndarray, begin: np.ndarray, end: np.ndarray, size: int):
    """Hashes of the ``size``-character shingles of each span (a shorter span is one shingle),
    offsets and owners of the hashes; the spans fill the buffer one after another."""
    if len(buf) and buf.max() < 0x80:
        chars, first, values = buf, begin, _CHAR_VALUES[0][buf]
    else:
        chars = np.flatnonzero((buf & 0xC0) != 0x80)
        first, values = np.searchsorted(chars, begin), _char_values(buf, chars)
    n_chars = np.diff(np.append(first, len(chars)))
    up, down = tb.power_tables(len(chars))
    values *= up[:-1]
    sums = np.zeros(len(chars) + 1, np.uint64)
    np.cumsum(values, out=sums[1:])
    line_of_char = np.repeat(np.arange(len(begin)), n_chars)
    if len(chars) >= size:
        # windows over the whole buffer, those across two lines left out
        inside = line_of_char[:len(chars) - size + 1] == line_of_char[size - 1:]
        hashes = ((sums[size:] - sums[:-size]) * down[:len(chars) - size + 1])[inside]
        line = line_of_char[:len(chars) - size + 1][inside]
    else:
        hashes, line = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = np.flatnonzero(n_chars < size)
    if len(short):
        whole = (sums[first[short] + n_chars[short]] - sums[first[short]]) * down[first[short]] + n_chars[short].astype(np.uint64)
        at = np.searchsorted(line, short)
        hashes, line = np.insert(hashes, at, whole), np.insert(line, at, short)
    return tb.mix(hashes), tb.bounds(np.bincount(line, minlength=len(begin))), line


def _one_permutation(hashes: np.ndarray, line: np.ndarray, n: int, bins: int) -> np.ndarray:
    empty = np.uint32(0xFFFFFFFF)
    slot = ((hashes >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
    sig = np.full(n * bins, empty, np.uint32)
    np.minimum.at(sig, line * bins + slot.view(np.int64), hashes.astype(np.uint32) >> np.uint32(1))
    sig = sig.reshape(n, bins)
    filled = sig != empty
    rng = np.random.RandomState(77)
    row, col = np.nonzero(~filled)
    source = sig.copy()
    for attempt in range(6 * bins):
        if not len(row):
            break
        # after the random probes, walk the bins one by one, so that every hole is filled
        probe = rng.randint(0, bins, bins)[col] if attempt < 5 * bins else (col + attempt) % bins
        found = filled[row, probe]
        sig[row[found], col[found]] = source[row[found], probe[found]]
        row, col = row[~found], col[~found]
    return sig


def _documents(docs: DataFrame) -> DataFrame:
    """(doc_id, tx, text): ``tx`` tells rows of one doc_id with different texts apart."""
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("tx"),
                        F.col("text").cast("string").alias("text")).filter("doc_id is not null and text is not null"))


def occurrences(docs: DataFrame) -> DataFrame:
    """(doc_id, tx, line_no, id) of every line with a word; equal lines have one id."""

    def run(batches):
        for batch in batches:
            for s in tb.slices(batch.column(2), PIECE_BYTES):
                buf, begin, end, doc, number = _lines(s)
                node = tb.span_hash(tb.prefix_hash(buf), begin, end)
                at = pa.array(doc)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(k).slice(s.first, s.n).take(at) for k in (0, 1)], pa.array(number.astype(np.int32)),
                     pa.array(node.view(np.int64))], names=["doc_id", "tx", "line_no", "id"])

    return docs.mapInArrow(run, "doc_id long, tx long, line_no int, id long")


def _bucket_heads(key: np.ndarray, node: np.ndarray):
    """Distinct keys, the smallest node of each, and the rows (key, node, head) of the other nodes."""
    order = np.argsort(key)
    key, node = key[order], node[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else order
    head = np.minimum.reduceat(node, first) if len(key) else node
    of = np.repeat(head, np.diff(np.append(first, len(key))))
    other = np.flatnonzero(node != of)
    _, once = np.unique(tb.mix(key[other] + node[other] * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
    other = other[once]
    return key[first], head, (key[other], node[other], of[other])


def bucket_members(docs: DataFrame, families: tuple, bands: int, rows: int, bits: int) -> DataFrame:
    """(key, id, head): members of the bands' shared buckets, each with a line it is compared with.
    The last two bits of a key are the number of the family.

    A task keeps one line per bucket, the head, for the exchange, and ties the bucket's other lines that it
    has seen to that head; the shard of a bucket does the same with the tasks' heads. So a bucket
    brings at most one entry of each task to its shard, however many lines it holds.
    """

    def scan(batches):
        # lines that this task has just seen, by the first bits of their hash; a forgotten one is only done again
        seen, held, n = np.zeros(1 << 18, np.uint64), [], 0

        def flush():
            keys, heads, others = _bucket_heads(*[np.concatenate(c) for c in zip(*held)])
            at = cuts(shard_of(keys, bits), bits)
            for k in np.flatnonzero(np.diff(at)):
                yield _block(int(k), "heads", [keys[at[k]:at[k + 1]], heads[at[k]:at[k + 1]]])
            # rows that need no exchange by key are dealt evenly
            for lo in range(0, len(others[0]), PASSED):
                order = lo + np.argsort(others[0][lo:lo + PASSED])
                yield _block(int(others[1][lo] % np.uint64(1 << bits)), "members", [c[order] for c in others])

        for batch in batches:
            for s in tb.slices(batch.column(2), PIECE_BYTES):
                buf, begin, end, _, _ = _lines(s)
                node = tb.span_hash(tb.prefix_hash(buf), begin, end)
                distinct, at = np.unique(node, return_index=True)
                slot = distinct >> np.uint64(46)
                new = np.zeros(len(begin), bool)
                new[at[seen[slot] != distinct]] = True
                seen[slot] = distinct
                length = end - begin
                chars = np.append(np.cumsum((buf & 0xC0) != 0x80), 0)[end - 1] if len(end) else end
                chars = np.diff(chars, prepend=0)
                for family, (size, over, most) in enumerate(families):
                    chosen = new & (chars > over) & (chars <= most)
                    count = int(chosen.sum())
                    if not count:
                        continue
                    ends = np.cumsum(length[chosen])
                    hashes, _, line = _shingles(buf[np.repeat(chosen, length)], ends - length[chosen], ends, size)
                    sig = _one_permutation(hashes, line, count, bands * rows).astype(np.uint64).reshape(-1, bands, rows)
                    keys = np.broadcast_to(np.arange(bands, dtype=np.uint64), sig.shape[:2])
                    for k in range(rows):
                        keys = tb.mix(keys * np.uint64(0x9E3779B97F4A7C15) + sig[:, :, k])
                    held.append(((keys.ravel() & ~np.uint64(3)) | np.uint64(family), np.repeat(node[chosen], bands)))
                    n += count * bands
                if n >= HELD:
                    yield from flush()
                    held, n = [], 0
        if held:
            yield from flush()

    def merge(batches):
        at, heads = None, []

        def done():
            if heads:
                columns = [np.concatenate(c) for c in zip(*heads)]
                heads.clear()
                yield _members(*_bucket_heads(*columns)[2])

        for batch in batches:
            for k in range(batch.num_rows):
                columns = unpack(batch.column(2)[k].as_buffer())
                if batch.column(1)[k].as_py() == "members":
                    yield _members(*columns)
                    continue
                if batch.column(0)[k].as_py() != at:
                    yield from done()
                    at = batch.column(0)[k].as_py()
                heads.append(columns)
        yield from done()

    return (docs.mapInArrow(scan, "shard int, kind string, block binary").repartition(4 << bits, "shard", "kind")
            .sortWithinPartitions("shard", "kind").mapInArrow(merge, "key long, id long, head long"))


def _block(shard: int, kind: str, columns: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([kind]), pa.array([pack(columns)], pa.binary())],
                                      names=["shard", "kind", "block"])


def _members(key: np.ndarray, node: np.ndarray, head: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in (key, node, head)], names=["key", "id", "head"])


def _line_sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles (52 bits of the hash) of each value of a column of single lines, and their offsets."""
    parts, sizes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for lo in range(0, len(column), 1 << 12):
        for s in tb.slices(column.slice(lo, 1 << 12), PIECE_BYTES):
            buf, begin, end, doc, _ = _lines(s)
            hashes, _, line = _shingles(buf, begin, end, size)
            tagged = np.sort((doc[line].astype(np.uint64) << np.uint64(52)) | (hashes >> np.uint64(12)))
            tagged = tagged[np.append(True, tagged[1:] != tagged[:-1])] if len(tagged) else tagged
            parts.append(tagged & np.uint64((1 << 52) - 1))
            sizes.append(tb.counts((tagged >> np.uint64(52)).astype(np.int64), s.n))
    return np.concatenate(parts), tb.bounds(np.concatenate(sizes))


def _common(items: np.ndarray, at: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Size of the intersection of the sets ``left`` and ``right`` of each of at most 4096 pairs."""
    def of(index):
        sizes = at[index + 1] - at[index]
        into = tb.bounds(sizes)
        pair = np.repeat(np.arange(len(index)), sizes)
        return items[np.arange(into[-1]) + (at[index] - into[:-1])[pair]] | (pair.astype(np.uint64) << np.uint64(52))

    both = np.sort(np.concatenate([of(left), of(right)]))
    return tb.counts((both[1:][both[1:] == both[:-1]] >> np.uint64(52)).astype(np.int64), len(left))


def _each_family(batches, families: tuple):
    """(family, size of its shingles, rows) of batches whose first column is the number of a family."""
    for batch in batches:
        number = batch.column(0).to_numpy()
        for k, (size, _, _) in enumerate(families):
            if (rows := np.flatnonzero(number == k)).size:
                yield k, size, batch.take(pa.array(rows))


def verified_lines(pairs: DataFrame, texts: DataFrame, families: tuple, percent: int) -> DataFrame:
    """Pairs (a, b) of (family, a, b) whose lines' exact shingle sets reach the threshold."""

    def run(batches):
        for _, size, batch in _each_family(batches, families):
            # a line that several pairs of the batch hold is read once
            ids = np.concatenate([batch.column(k).to_numpy() for k in (1, 2)])
            _, row, line = np.unique(ids, return_index=True, return_inverse=True)
            items, at = _line_sets(pa.concat_arrays([batch.column(3), batch.column(4)]).take(pa.array(row)), size)
            n = np.diff(at)
            left, right = line[:batch.num_rows], line[batch.num_rows:]
            least, most = np.minimum(n[left], n[right]), np.maximum(n[left], n[right])
            possible = np.flatnonzero(100 * least >= percent * most)
            linked = [np.zeros(0, np.int64)]
            for lo in range(0, len(possible), 1 << 12):
                pair = possible[lo:lo + (1 << 12)]
                common = _common(items, at, left[pair], right[pair])
                linked.append(pair[100 * common >= percent * (least[pair] + most[pair] - common)])
            yield batch.select([1, 2]).take(pa.array(np.concatenate(linked)))

    side = lambda c: texts.withColumnsRenamed({"id": c, "line": f"line_{c}"})
    return (pairs.join(side("a"), "a").join(side("b"), "b").select("family", "a", "b", "line_a", "line_b")
            .mapInArrow(run, "a long, b long"))


def line_maps(texts: DataFrame, families: tuple) -> DataFrame:
    """(family, id, n, bits) of (family, id, line): the number of a line's distinct shingles, and per bit whether an
    odd number of them falls on it."""

    def run(batches):
        for k, size, batch in _each_family(batches, families):
            for lo in range(0, batch.num_rows, 1 << 10):
                part = batch.slice(lo, 1 << 10)
                items, at = _line_sets(part.column(2), size)
                line = np.repeat(np.arange(part.num_rows), np.diff(at))
                odd = np.bincount(line * MAP_BITS + (items % np.uint64(MAP_BITS)).astype(np.int64), minlength=part.num_rows * MAP_BITS) & 1
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(np.diff(at)),
                     tb.lists(np.packbits(odd.astype(bool)).view(np.uint64), np.arange(part.num_rows + 1) * (MAP_BITS // 64))],
                    names=["family", "id", "n", "bits"])

    return texts.select("family", "id", "line").mapInArrow(run, "family long, id long, n long, bits array<bigint>")


def _apart(a: str, b: str) -> Column:
    """Bits in which two maps differ: at most the number of shingles that only one of the lines has."""
    return F.expr(" + ".join(f"bit_count({a}[{k}] ^ {b}[{k}])" for k in range(MAP_BITS // 64)))


def _possible(a: str, b: str, percent: int) -> Column:
    """Whether lines ``{a}_n, {a}_bits`` and ``{b}_n, {b}_bits`` may reach the threshold (exact bounds)."""
    n_a, n_b = F.col(f"{a}_n"), F.col(f"{b}_n")
    return ((100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b))
            & ((100 + percent) * _apart(f"{a}_bits", f"{b}_bits") <= (100 - percent) * (n_a + n_b)))


def central_pairs(placed: DataFrame, percent: int) -> DataFrame:
    """Pairs (family, a, b) of the lines outside a large bucket's largest component with the most central
    line of that component: of its lines the one nearest to three of them, so that the least edited of
    a large group of near copies meets all others. ``placed`` has (key, id, comp, n, bits)."""
    line = lambda i: F.struct(i.alias("id"), "bits")
    parts = placed.groupBy("key", "comp").agg(
        F.count(F.lit(1)).alias("members"), F.min(line(F.col("id"))).alias("p"), F.max(line(F.col("id"))).alias("q"),
        F.min(line(F.col("id").bitwiseXOR(F.lit(0x2545F4914F6CDD1D)))).alias("r"))
    main = (parts.groupBy("key").agg(F.max(F.struct("members", F.col("comp").alias("main"), "p", "q", "r")).alias("m"),
                                     F.count(F.lit(1)).alias("comps"), F.sum("members").alias("size"))
            .filter((F.col("comps") > 1) & (F.col("size") > FEW)).select("key", "m.main", "m.p", "m.q", "m.r"))
    away = _apart("bits", "p.bits") + _apart("bits", "q.bits") + _apart("bits", "r.bits")
    central = (placed.join(main, "key").filter("comp = main").groupBy("key", "main")
               .agg(F.min(F.struct(away.alias("away"), "id", "n", "bits")).alias("c"))
               .select("key", "main", F.col("c.id").alias("b"), F.col("c.n").alias("b_n"), F.col("c.bits").alias("b_bits")))
    return (placed.withColumnsRenamed({"n": "a_n", "bits": "a_bits"}).join(central, "key")
            .filter((F.col("comp") != F.col("main")) & _possible("a", "b", percent))
            .select(F.col("key").bitwiseAND(F.lit(3)).alias("family"), F.col("id").alias("a"), "b").distinct())


def further_pairs(placed: DataFrame, percent: int) -> DataFrame:
    """Pairs (family, a, b) of one bucket that could still join two components, given (key, id, comp, n, bits).

    Lines outside their bucket's largest component meet those of other components, if sizes and maps allow
    a link; pairs inside a component are never formed.
    """
    main = (placed.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("members"))
            .groupBy("key").agg(F.max(F.struct("members", "comp")).alias("m"), F.count(F.lit(1)).alias("comps"))
            .filter("comps > 1").select("key", F.col("m.comp").alias("main")))
    split = cut(placed.join(main, "key"))
    side = lambda c, *more: ["key", *[F.col(x).alias(f"{c}_{x}") for x in ("id", "n", "bits", "comp")], *more]
    met = split.filter("comp <> main").select(*side("a")).join(split.select(*side("b", "main")), "key").filter(
        (F.col("a_comp") != F.col("b_comp")) & ((F.col("b_comp") == F.col("main")) | (F.col("a_id") < F.col("b_id")))
        & _possible("a", "b", percent))
    return met.select(F.col("key").bitwiseAND(F.lit(3)).alias("family"), F.col("a_id").alias("a"), F.col("b_id").alias("b")).distinct()


def merged(found: DataFrame, links: DataFrame) -> DataFrame:
    """(id, component) of ``found`` after ``links`` (a, b) have joined components (both materialized)."""
    if links.isEmpty():
        return found
    of = lambda c: checked(found, found.select(F.col("id").alias(c), F.col("component").alias(f"of_{c}")), columns=2)
    joined = (links.join(of("a"), "a", "left").join(of("b"), "b", "left")
              .select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b")))
    final = cut(components(joined).select("node", F.col("component").alias("final")))
    fresh = final.select(F.col("node").alias("id"), F.col("node").alias("component")).join(checked(found, found.select("id"), columns=2), "id", "left_anti")
    # a union has the tasks of both sides
    tasks = int(links.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut(found.select("id", "component").union(fresh).join(checked(final, columns=2), F.col("component") == F.col("node"), "left")
               .select("id", F.coalesce("final", "component").alias("component")).coalesce(tasks))


def line_components(docs: DataFrame, table: DataFrame, members: DataFrame, families: tuple, percent: int) -> DataFrame:
    """(id, component) of the lines that have a near copy with another normalized text (materialized).

    ``table`` has (doc_id, tx, line_no, id) of all lines; it and ``members`` are materialized.
    """
    family = F.col("key").bitwiseAND(F.lit(3)).alias("family")
    stars = cut(members.select(family, F.col("id").alias("a"), F.col("head").alias("b")).distinct())
    ids = cut(stars.select(F.explode(F.array("a", "b")).alias("id")).distinct())
    # a line is read at one of its places: equal lines have equal words
    places = cut(table.join(checked(ids, columns=1), "id", "left_semi").dropDuplicates(["id"])
                 .select("id", F.col("doc_id").alias("d"), F.col("tx").alias("t"), "line_no"))
    wanted = places.groupBy("d", "t").agg(F.collect_list(F.struct("line_no", "id")).alias("want"))
    texts = cut(docs.join(checked(places, wanted, columns=4), (F.col("doc_id") == F.col("d")) & (F.col("tx") == F.col("t")))
                .select("want", F.split("text", "\n", -1).alias("pieces"))
                .select(F.explode(F.transform("want", lambda w: F.struct(
                    w["id"].alias("id"), F.get(F.col("pieces"), w["line_no"]).alias("line")))).alias("x")).select("x.*")
                # a repeated row has the line again
                .dropDuplicates(["id"]))

    def linked(pairs: DataFrame, lines: DataFrame) -> DataFrame:
        return cut(verified_lines(pairs, lines, families, percent))

    found = cut(components(linked(stars, texts)).withColumnRenamed("node", "id"))

    # a bucket of two lines is settled; in larger ones members of different components may still be linked
    def component(rows: DataFrame, c: str, name: str) -> DataFrame:
        of = checked(found, found.select(F.col("id").alias("__node"), F.col("component").alias("__of")), columns=2)
        return rows.join(of, F.col(c) == F.col("__node"), "left").withColumn(name, F.coalesce("__of", c)).drop("__node", "__of")

    open_keys = cut(component(component(members, "id", "comp"), "head", "other").groupBy("key")
                    .agg(F.count(F.lit(1)).alias("n"), F.max(F.col("comp") != F.col("other")).alias("open")).filter("n > 1 and open").select("key"))
    inside = (members.join(checked(open_keys, columns=1), "key", "left_semi")
              .select("key", F.explode(F.array("id", "head")).alias("id")).distinct())
    inside = cut(inside.select("key", "id", family))
    wanted = cut(inside.select("id", "family").distinct())
    few = cut(texts.join(checked(wanted, columns=2), "id", "left_semi"))
    maps = cut(line_maps(few.join(checked(wanted, columns=2), "id"), families))
    placed = cut(inside.join(checked(maps, columns=3 + MAP_BITS // 64), ["id", "family"]).drop("family"))
    # many pairs of few lines: their texts go to the pairs if they are counted to be small
    n_bytes = few.agg(F.sum(F.octet_length("line") + 16)).first()[0] or 0
    lines = F.broadcast(few) if n_bytes <= BROADCAST_BYTES else few
    for pairs in (central_pairs, further_pairs):
        found = merged(found, linked(cut(pairs(component(placed, "id", "comp"), percent)), lines))
    return found


def _of_groups(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """``rows`` with the columns of their group (``comp``); ``groups`` is materialized and has ``uses``."""
    if groups.count() * len(groups.columns) <= MAX_BROADCAST_VALUES:
        return rows.join(F.broadcast(groups), "comp")
    # lines of many uses meet them as a counted broadcast, so that no key of the other join is large
    often = cut(groups.filter(F.col("uses") > MANY_USES))
    return (rows.join(checked(often, columns=len(groups.columns)), "comp")
            .unionByName(rows.join(groups.filter(F.col("uses") <= MANY_USES), "comp")))


def duplicate_lines(docs: DataFrame, families: tuple, percent: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, tx, line_no) of the lines that go (materialized), of (doc_id, tx, text)."""
    table = cut(occurrences(docs))
    bits = bits_for(table.count() * bands, SHARD)
    members = cut(bucket_members(docs, families, bands, rows, bits))
    found = line_components(docs, table, members, families, percent)
    discard(members)
    # equal lines, and lines in one component, stay at the smallest place: in the smallest document, then by line and text
    placed = (table.join(checked(found, columns=2), "id", "left")
              .select("doc_id", "tx", "line_no", F.coalesce("component", "id").alias("comp")))
    groups = cut(placed.groupBy("comp").agg(F.count(F.lit(1)).alias("uses"), F.min("doc_id").alias("k_doc")).filter("uses > 1"))
    repeated = cut(_of_groups(placed, groups))
    kept = cut(repeated.filter("doc_id = k_doc").groupBy("comp", "uses", "k_doc").agg(F.min(F.struct("line_no", "tx")).alias("at"))
               .select("comp", "uses", "k_doc", F.col("at.line_no").alias("k_line"), F.col("at.tx").alias("k_tx")))
    away = ~((F.col("doc_id") == F.col("k_doc")) & (F.col("line_no") == F.col("k_line")) & (F.col("tx") == F.col("k_tx")))
    gone = _of_groups(repeated.drop("uses", "k_doc"), kept).filter(away).select("doc_id", "tx", "line_no").distinct()
    return cut(gone)


def dedup_lines(docs: DataFrame, families: tuple = FAMILIES, percent: int = 80, bands: int = 12, rows: int = 4) -> DataFrame:
    """``docs`` with repeated lines removed from ``text``, plus n_lines (lines with a word) and
    n_removed (int).

    ``families`` lists up to four (shingle size, over, most): lines of more than ``over`` and at most ``most``
    characters are compared by shingles of that size. Of the lines linked by ``100 * intersection >= percent *
    union`` of their shingle sets in a family (transitively; equal lines included) only the one with the smallest (doc_id, line number)
    stays; lines without a word always stay. Rows with a null doc_id or a null text are left as
    they are and are no evidence against others. Rows of one doc_id with equal texts are one document and
    lose the same lines; rows of one doc_id with different texts are documents of their own, and
    at equal line numbers the text with the smaller hash counts as the first. Other columns are passed through.
    """
    gone = duplicate_lines(_documents(docs), families, percent, bands, rows)
    of_doc = gone.groupBy(F.col("doc_id").alias("__doc"), F.col("tx").alias("__tx")).agg(F.collect_list("line_no").alias("__gone"))
    pieces = F.split("text", "\n", -1)
    # from a line's first word to its end: one match per line with a word
    with_word = F.regexp_count(F.col("text").cast("string"), F.lit(r"[^\x20\x09-\x0D][^\n]*"))
    rest = F.filter(pieces, lambda x, i: ~F.array_contains(F.col("__gone"), i))
    same = (F.col("doc_id").cast("long") == F.col("__doc")) & (F.xxhash64(F.col("text").cast("string")) == F.col("__tx"))
    joined = docs.join(checked(gone, of_doc), same, "left")
    return joined.select(
        *[(F.when(F.col("__gone").isNull(), F.col("text")).otherwise(F.array_join(rest, "\n")) if c == "text" else F.col(f"`{c}`")).alias(c)
          for c in docs.columns],
        F.when(F.col("text").isNull(), 0).otherwise(with_word).alias("__n_lines"),
        F.coalesce(F.size("__gone"), F.lit(0)).alias("__n_removed"))
