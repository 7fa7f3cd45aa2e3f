"""Vectorized work on the UTF-8 bytes of an Arrow string column.

Every helper sees a slice of whole texts as one byte buffer plus start offsets, so tokenizing and
hashing a batch takes a fixed number of numpy passes and no Python object per word. Texts are
never cut: a text longer than ``SLICE_BYTES`` forms a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes per numpy pass (bounds the memory of a Python worker: about 100 bytes per byte of slice).
SLICE_BYTES = 1 << 20

_MULT = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_BASE = 0xD1342543DE82EF95
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)

#: Fixed random 64-bit value per byte, so that the polynomial hash has no small coefficients.
_BYTE_VALUES = np.random.RandomState(20240607).randint(0, 1 << 62, size=256, dtype=np.int64).astype(np.uint64) * np.uint64(4) + np.uint64(1)

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: Bytes with A-Z lower-cased and everything else unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


@dataclass
class Slice:
    """Whole texts ``first .. first + n - 1`` of a batch: their bytes and n + 1 offsets into them."""

    first: int
    buf: np.ndarray
    offsets: np.ndarray

    @property
    def n(self) -> int:
        return len(self.offsets) - 1


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Split a string column into slices of whole texts; a null text counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return
    large = pa.types.is_large_string(column.type)
    bufs = column.buffers()
    offsets = np.frombuffer(bufs[1], np.int64 if large else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        yield Slice(first, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first])
        first = last


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finalizer."""
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0x7FB5D329728EA185)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x81DADEF4BC2DD44D)
    h ^= h >> np.uint64(33)
    return h


_powers: dict[str, np.ndarray] = {}


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 .. n of the hash base and of its inverse."""
    if len(_powers.get("up", ())) < n + 1:
        size = max(n + 1, 1 << 16)
        for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[name] = np.multiply.accumulate(table)
    return _powers["up"][:n + 1], _powers["down"][:n + 1]


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """Running polynomial sums; ``span_hash`` turns any byte span into a 64-bit hash."""
    up, _ = power_tables(len(buf))
    out = np.zeros(len(buf) + 1, np.uint64)
    values = _BYTE_VALUES[buf]
    values *= up[:-1]
    np.cumsum(values, out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of ``buf[start:end]`` per span (equal bytes give equal hashes wherever they stand)."""
    _, down = power_tables(len(prefix) - 1)
    return mix((prefix[end] - prefix[start]) * down[start])


def owner(offsets: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """Index of the text that holds each byte position (empty texts hold none)."""
    return np.searchsorted(offsets, positions, side="right") - 1


def spans(keep: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of ``keep`` that do not cross a text boundary."""
    if not len(keep):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    boundary = np.zeros(len(keep) + 1, bool)
    boundary[offsets] = True
    begins = keep.copy()
    begins[1:] &= ~keep[:-1] | boundary[1:-1]
    ends = keep.copy()
    ends[:-1] &= ~keep[1:] | boundary[1:-1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def words(s: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text index of every word ``[^\\x20\\x09-\\x0D]+``."""
    start, end = spans(~IS_SPACE[s.buf], s.offsets)
    return start, end, owner(s.offsets, start)


def counts(index: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(index, minlength=n).astype(np.int64)


def bounds(sizes: np.ndarray) -> np.ndarray:
    """Offsets (n + 1) of consecutive groups of the given sizes."""
    out = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=out[1:])
    return out


def group_reduce(ufunc, values: np.ndarray, offsets: np.ndarray, empty) -> np.ndarray:
    """``ufunc.reduceat`` over consecutive groups, with ``empty`` for groups without values."""
    n = len(offsets) - 1
    out = np.full((n, *values.shape[1:]), empty, values.dtype)
    full = np.flatnonzero(offsets[1:] > offsets[:-1])
    if len(full):
        out[full] = ufunc.reduceat(values, offsets[full], axis=0)
    return out


def word_shingles(s: Slice, size: int, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's ``size``-word shingles, and their offsets.

    A text with fewer words, but at least one, has its whole word sequence as its one shingle.
    """
    buf = LOWER[s.buf] if lower else s.buf
    start, end, doc = words(s)
    hashes = span_hash(prefix_hash(buf), start, end)
    n_words = counts(doc, s.n)
    at = bounds(n_words)
    short = (n_words > 0) & (n_words < size)
    length = np.where(short, n_words, size)
    n_sh = np.where(n_words > 0, n_words - length + 1, 0)
    sh_at = bounds(n_sh)
    sh_doc = np.repeat(np.arange(s.n), n_sh)
    first = np.arange(sh_at[-1]) - sh_at[sh_doc] + at[sh_doc]
    value = np.zeros(sh_at[-1], np.uint64)
    for k in range(size):
        more = k < length[sh_doc]
        step = hashes[np.minimum(first + k, max(len(hashes) - 1, 0))] if len(hashes) else hashes
        value = np.where(more, mix(value * np.uint64(_MULT) + step), value)
    parts = [np.unique(value[sh_at[i]:sh_at[i + 1]]) for i in range(s.n)]
    sizes = np.array([len(p) for p in parts], np.int64)
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), bounds(sizes)


def lists(values: np.ndarray, offsets: np.ndarray) -> pa.ListArray:
    """Arrow list column of int64 from a flat array and group offsets."""
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.view(np.int64)))
