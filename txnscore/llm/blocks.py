"""Sorted columns of 64-bit numbers as compressed blocks, one per shard of a hash range.

Tasks that sort and combine their numbers in numpy hand them on as one row per shard; a number then
costs a few bytes in a shuffle instead of a row.
"""

from __future__ import annotations

import numpy as np
import zstandard


def pack(columns: list[np.ndarray]) -> bytes:
    """64-bit columns as compressed planes of bytes; the first one is sorted and stored as differences."""
    planes = [np.array([len(columns), len(columns[0])], np.int64).tobytes()]
    for k, c in enumerate(columns):
        c = np.diff(c.astype(np.uint64), prepend=np.uint64(0)) if k == 0 else c.astype(np.uint64)
        planes.append(np.ascontiguousarray(c.view(np.uint8).reshape(-1, 8).T).tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpack(block: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(block)
    m, n = np.frombuffer(raw, np.int64, 2)
    cells = np.frombuffer(raw, np.uint8, offset=16).reshape(m, 8, n)
    out = [np.ascontiguousarray(cells[k].T).view(np.uint64).reshape(-1) for k in range(m)]
    out[0] = np.cumsum(out[0], dtype=np.uint64)
    return out


def shard_of(keys: np.ndarray, bits: int) -> np.ndarray:
    """The first ``bits`` bits of every key."""
    return (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)


def cuts(sorted_shards: np.ndarray, bits: int) -> np.ndarray:
    """Offsets of the shards 0 .. 2^bits - 1 in a sorted column of shard numbers."""
    return np.searchsorted(sorted_shards, np.arange((1 << bits) + 1)) if bits else np.array([0, len(sorted_shards)])


def bits_for(n: int, per_shard: int) -> int:
    """Bits of the number of shards that ``n`` numbers need."""
    return max(0, -(-n // per_shard) - 1).bit_length()
