"""Quality classifier: random Fourier features of document statistics, ridge, isotonic calibration.

One pass over the texts turns every document into a short vector of statistics. Random Fourier
features approximate a Gaussian kernel over the standardized statistics; every partition of labelled
rows sums its part of the normal equations, the sums are added up in two levels, and the ridge
solution is a fixed-size vector. The raw scores of the labelled rows are counted in fixed bins,
and pool-adjacent-violators over the bins gives the calibrated score. All labelled rows take part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .graph import checked
from .tables import cut, fold

FEATURES, RIDGE, SEED = 160, 1.0, 11
#: Partial sums that reach the driver, each FEATURES squared doubles.
PARTS = 8
BINS, LOW, HIGH = 600, -1.0, 2.0

_CLASSES = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "digit": b"0123456789", "symbol": b"#*$%&|<>",
            "shout": b"!?", "stop": b".,;:", "bracket": b"()[]{}\"'", "other": b"/\\=+~^_@-", "space": b" \t\x0b\x0c\r"}
N_STATS = len(_CLASSES) + 10


def statistics(s: tb.Slice) -> np.ndarray:
    """Statistics of each text of a slice (n x N_STATS), finite for any text."""
    size = np.maximum(np.diff(s.offsets), 1).astype(float)
    text = np.repeat(np.arange(s.n), np.diff(s.offsets))
    cols = []
    for chars in _CLASSES.values():
        member = np.zeros(256, bool)
        member[list(chars)] = True
        cols.append(np.bincount(text[member[s.buf]], minlength=s.n) / size)
    cols.append(np.bincount(text[s.buf >= 128], minlength=s.n) / size)
    start, end, doc = tb.words(s)
    n_words = np.bincount(doc, minlength=s.n)
    some = np.maximum(n_words, 1)
    length = end - start
    cols += [np.log1p(n_words), np.bincount(doc, length, minlength=s.n) / some,
             np.sqrt(np.bincount(doc, length.astype(float) ** 2, minlength=s.n) / some),
             np.bincount(doc[length == 1], minlength=s.n) / some]
    last = s.buf[end - 1] if len(end) else s.buf[:0]
    cols += [np.bincount(doc[np.isin(last, list(b".!?"))], minlength=s.n) / some,
             np.bincount(doc[np.isin(last, list(b"#*$%&|<>"))], minlength=s.n) / some]
    hashes = tb.span_hash(tb.prefix_hash(s.buf), start, end)
    owned = np.sort(tb.mix(hashes + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20) | doc.astype(np.uint64) << np.uint64(44))
    fresh = np.ones(len(owned), bool)
    fresh[1:] = owned[1:] != owned[:-1]
    cols.append(np.bincount((owned[fresh] >> np.uint64(44)).astype(np.int64), minlength=s.n) / some)
    n_lines = 1 + np.bincount(text[s.buf == 0x0A], minlength=s.n)
    cols += [np.log1p(n_words / n_lines), np.log1p(n_lines)]
    return np.stack(cols, axis=1)


def document_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, stats) of every row; null and empty texts have the statistics of no words."""

    def run(batches):
        for batch in batches:
            for s in tb.slices(batch.column(1)):
                x = statistics(s).astype(np.float32)
                stats = pa.ListArray.from_arrays(pa.array(np.arange(s.n + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(s.first, s.n), stats], names=["doc_id", "stats"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, stats array<float>")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1).astype(float)


class Fourier:
    """Fixed random features of statistics standardized by ``mean`` and ``std``."""

    def __init__(self, mean: np.ndarray, std: np.ndarray, seed: int = SEED):
        rng = np.random.RandomState(seed)
        self.mean, self.std = mean, np.where(std > 1e-9, std, 1.0)
        self.w = rng.normal(size=(len(mean), FEATURES)) / np.sqrt(len(mean))
        self.b = rng.uniform(0, 2 * np.pi, FEATURES)

    def __call__(self, stats: np.ndarray) -> np.ndarray:
        # far outliers would only turn the phase at random
        x = np.clip((stats - self.mean) / self.std, -6, 6)
        z = np.sqrt(2 / FEATURES) * np.cos(x @ self.w + self.b)
        return np.hstack([z, np.ones((len(z), 1))])


class Model:
    def __init__(self, fourier: Fourier, beta: np.ndarray, knots: np.ndarray, values: np.ndarray):
        self.fourier, self.beta, self.knots, self.values = fourier, beta, knots, values

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(self.fourier(stats) @ self.beta, LOW, HIGH - 1e-9)

    def scores(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(stats), self.knots, self.values)


def isotonic(n: np.ndarray, positive: np.ndarray) -> np.ndarray:
    """Non-decreasing rates of consecutive bins by pooling adjacent violators (all n > 0)."""
    blocks: list[list[float]] = []
    for size, hits in zip(n, positive):
        blocks.append([float(size), float(hits), 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            size_, hits_, k = blocks.pop()
            blocks[-1] = [blocks[-1][0] + size_, blocks[-1][1] + hits_, blocks[-1][2] + k]
    return np.concatenate([np.full(k, hits / size) for size, hits, k in blocks]) if blocks else np.zeros(0)


def _normal_equations(rows: DataFrame, fourier: Fourier) -> np.ndarray:
    """Sum of [Z y]' [Z y] over (stats, y): per partition, then in ``PARTS`` groups of partitions."""
    width = FEATURES + 2

    def add(batches):
        total = np.zeros((width, width))
        for batch in batches:
            z = np.hstack([fourier(_matrix(batch.column(0))), batch.column(1).to_numpy()[:, None].astype(float)])
            total += z.T @ z
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])

    def merge(batches):
        total = np.zeros(width * width)
        for batch in batches:
            for raw in batch.column(0):
                total += np.frombuffer(raw.as_py())
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])

    parts = rows.select("stats", "y").mapInArrow(add, "part binary").repartition(PARTS).mapInArrow(merge, "part binary").collect()
    return sum((np.frombuffer(p["part"]) for p in parts), np.zeros(width * width)).reshape(width, width)


def train(rows: DataFrame) -> Model:
    """Fit on labelled (stats, y) rows."""
    moments = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("ones"), *[f(F.get("stats", i).cast("double")).alias(f"{k}{i}")
                       for i in range(N_STATS) for k, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    n = moments["n"]
    if not n:
        return Model(Fourier(np.zeros(N_STATS), np.ones(N_STATS)), np.zeros(FEATURES + 1), np.array([LOW, HIGH]), np.array([0.5, 0.5]))
    fourier = Fourier(*(np.array([moments[f"{k}{i}"] for i in range(N_STATS)], float) for k in "ms"))
    equations = _normal_equations(rows, fourier)
    penalty = RIDGE * np.eye(FEATURES + 1)
    penalty[-1, -1] = 1e-9
    beta = np.linalg.solve(equations[:-1, :-1] + penalty, equations[:-1, -1])
    model = Model(fourier, beta, np.zeros(0), np.zeros(0))

    def bins(batches):
        total = np.zeros((BINS, 2), np.int64)
        for batch in batches:
            at = ((model.raw(_matrix(batch.column(0))) - LOW) / (HIGH - LOW) * BINS).astype(int)
            total[:, 0] += np.bincount(at, minlength=BINS)
            total[:, 1] += np.bincount(at, batch.column(1).to_numpy(), minlength=BINS).astype(np.int64)
        full = np.flatnonzero(total[:, 0])
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(total[full, 0]), pa.array(total[full, 1])], names=["bin", "n", "ones"])

    counted = (rows.select("stats", "y").mapInArrow(bins, "bin long, n long, ones long")
               .groupBy("bin").agg(F.sum("n").alias("n"), F.sum("ones").alias("ones")).orderBy("bin").toPandas())
    model.knots = LOW + (counted.bin.to_numpy(float) + 0.5) * (HIGH - LOW) / BINS
    # a tenth of a row of each class per bin keeps the ends off 0 and 1
    model.values = isotonic(counted.n.to_numpy(float) + 0.2, counted.ones.to_numpy(float) + 0.1)
    return model


def score(docs: DataFrame, labels: DataFrame, folds: int = 5, threshold: float = 0.3) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score (0 to 1), predicted (score >= threshold).

    Labels of ids whose crc32 modulo ``folds`` is 0 are not learned from. Null and empty texts score by
    the statistics of no words. Null labels and ids teach nothing, repeated labels of an id count once;
    without labels every score is 0.5. Rows may be repeated; an empty table gives no rows; other
    columns are ignored.
    """
    stats = cut(document_statistics(docs))
    usable = cut(labels.select(F.col("doc_id").alias("id"), F.col("quality").cast("int").alias("y"))
                 .filter("id is not null and y in (0, 1)").filter(fold(F.col("id"), folds) != 0).dropDuplicates(["id"]))
    model = train(cut(stats.join(checked(usable), F.col("doc_id") == F.col("id")).select("stats", "y")))

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.clip(model.scores(_matrix(batch.column(1))), 0, 1))],
                                             names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = stats.mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select("doc_id", (fold(F.col("doc_id"), folds) == 0).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
