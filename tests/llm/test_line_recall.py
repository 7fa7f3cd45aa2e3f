"""Line dedup: the bands find pairs above the threshold, by formula and by the signatures themselves."""

import inspect
import random

import numpy as np
import pyarrow as pa
import pytest

from txnscore.llm import line_dedup
from txnscore.llm import textbytes as tb


def _defaults():
    return {k: v.default for k, v in inspect.signature(line_dedup.dedup_lines).parameters.items()}


def test_bands_find_pairs_at_the_threshold():
    p = _defaults()
    assert (1 - (p["percent"] / 100) ** p["rows"]) ** p["bands"] <= 0.002


@pytest.mark.parametrize("size,short,long", [(5, 45, 100), (8, 81, 300)])
def test_signatures_of_similar_lines_share_a_band(size, short, long):
    p, rng = _defaults(), random.Random(8)
    assert any(f[0] == size for f in p["families"])
    lines = []
    for _ in range(4000):
        line = [rng.choice("abcdefghij ") for _ in range(rng.randint(short, long))]
        other = list(line)
        for _ in range(rng.randint(1, 3)):
            other[rng.randrange(len(other))] = rng.choice("abcdefghij")
        lines += ["x" + "".join(line) + "x", "x" + "".join(other) + "x"]
    (s,) = tb.slices(pa.array(lines), 1 << 30)
    buf, begin, end, _, _ = line_dedup._lines(s)
    hashes, at, line = line_dedup._shingles(buf, begin, end, size)
    sig = line_dedup._one_permutation(hashes, line, len(lines), p["bands"] * p["rows"]).reshape(-1, p["bands"], p["rows"])
    found = n = 0
    for k in range(0, len(lines), 2):
        x, y = (np.unique(hashes[at[i]:at[i + 1]]) for i in (k, k + 1))
        common = len(np.intersect1d(x, y))
        if 0.8 <= common / (len(x) + len(y) - common) < 0.9:
            n += 1
            found += (sig[k] == sig[k + 1]).all(axis=1).any()
    assert n > 1000 and found >= 0.99 * n
