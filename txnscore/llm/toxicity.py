"""Toxicity from subword-bag embeddings averaged into a linear softmax.

A word is the mean of the embeddings of its character n-grams (3 to 5 bytes, with a blank on both
sides) and of the whole word, all hashed into one table, so an unseen misspelling shares vectors with
what it resembles. A window of ``WINDOW`` words is the mean of its words and goes through a linear
softmax; embeddings and softmax are trained jointly in numpy. A text scores as its worst window,
so that a long text does not thin out one passage.

The labels are per text: a first pass trains every window with its text's label, a second one
trains the clean texts' windows against the worst windows of each toxic text only. At scoring
time softmax and embeddings collapse into one number per bucket, since averages are linear.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .graph import checked
from .tables import cut, fold

BUCKETS, DIM, NGRAMS = 1 << 16, 8, (3, 4, 5)
WINDOW, STRIDE = 6, 3
#: Documented bounds of the fit: texts per class, and the characters of a text that may be one of them.
SAMPLE, MAX_CHARS = {0: 3_000, 1: 1_500}, 20_000
STEPS, RATE = 18, 0.08
#: Buckets that fewer training texts use (counted word by word) get no vector: they would only be learned by heart.
MIN_TEXTS = 8
#: Every so many-th text of the sample is kept for the calibration.
CALIBRATION = 4

_WORD = np.zeros(256, bool)
_WORD[ord("a"):ord("z") + 1] = True
_WORD[ord("0"):ord("9") + 1] = True
_WORD[128:] = True


def _word_text(s: tb.Slice):
    """Lower-cased words with single blanks between and around them, word spans, and their texts."""
    low = tb.LOWER[s.buf]
    start, end = tb.spans(_WORD[low], s.offsets)
    doc = tb.owner(s.offsets, start)
    keep = _WORD[low]
    at = tb.bounds(keep)
    lo = at[start] + np.arange(len(start)) + 1
    hi = lo + (end - start)
    buf = np.full(int(keep.sum()) + len(start) + 1, 0x20, np.uint8)
    if len(start):
        inside = np.ones(len(buf), bool)
        inside[np.append(lo - 1, len(buf) - 1)] = False
        buf[inside] = low[keep]
    return buf, lo, hi, doc


def _subwords(buf: np.ndarray, lo: np.ndarray, hi: np.ndarray):
    """(word, bucket) of all subwords, ordered by word within each n-gram length."""
    prefix = tb.prefix_hash(buf)
    index = np.arange(len(lo))
    yield index, (tb.mix(tb.span_hash(prefix, lo, hi) + np.uint64(9)) % np.uint64(BUCKETS)).astype(np.int64)
    for n in NGRAMS:
        count = np.maximum(hi - lo + 2 - n + 1, 0)
        at = tb.bounds(count)
        word = np.repeat(index, count)
        first = np.arange(at[-1]) - at[word] + lo[word] - 1
        yield word, (tb.span_hash(prefix, first, first + n) % np.uint64(BUCKETS)).astype(np.int64)


def _windows(n_words: np.ndarray, stride: int = STRIDE):
    """First and last word, and text, of the windows of texts with the given numbers of words."""
    n = np.where(n_words > 0, np.maximum(-(-(n_words - WINDOW) // stride), 0) + 1, 0)
    at, word_at = tb.bounds(n), tb.bounds(n_words)
    text = np.repeat(np.arange(len(n)), n)
    first = word_at[text] + (np.arange(at[-1]) - at[text]) * stride
    return first, np.minimum(first + WINDOW, word_at[text + 1]), text, at


class Model:
    """One logit per subword bucket, the softmax's bias, and the calibration of a text's worst window."""

    def __init__(self, buckets: np.ndarray, bias: float, slope: float = 1.0, offset: float = 0.0):
        self.buckets, self.bias, self.slope, self.offset = buckets, bias, slope, offset

    def worst(self, s: tb.Slice) -> np.ndarray:
        """Largest window logit per text (the bias for a text without words)."""
        buf, lo, hi, doc = _word_text(s)
        total, n = np.zeros(len(lo)), np.zeros(len(lo))
        for word, bucket in _subwords(buf, lo, hi):
            total += np.bincount(word, self.buckets[bucket], minlength=len(lo))
            n += np.bincount(word, minlength=len(lo))
        sums = np.zeros(len(lo) + 1)
        np.cumsum(total / np.maximum(n, 1), out=sums[1:])
        first, last, _, at = _windows(tb.counts(doc, s.n))
        logit = (sums[last] - sums[first]) / np.maximum(last - first, 1) + self.bias
        return tb.group_reduce(np.maximum, logit, at, self.bias)

    def scores(self, s: tb.Slice) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.worst(s) + self.offset, -40, 40)))


class _Bags:
    """The training windows: distinct words with their subwords, windows with their words."""

    def __init__(self, texts: list[str]):
        hashes, docs, subs, at = [], [], [], 0
        for s in tb.slices(pa.array(texts, pa.string())):
            buf, lo, hi, doc = _word_text(s)
            h = tb.span_hash(tb.prefix_hash(buf), lo, hi)
            _, one = np.unique(h, return_index=True)
            for word, bucket in _subwords(buf, lo[one], hi[one]):
                subs.append((h[one][word], bucket))
            hashes.append(h)
            docs.append(doc + s.first)
        h = np.concatenate([np.zeros(0, np.uint64), *hashes])
        vocabulary, self.words = np.unique(h, return_inverse=True)
        empty = np.zeros(0, np.int64)
        key = np.unique(np.concatenate([empty, *(np.searchsorted(vocabulary, a) * BUCKETS + b for a, b in subs)]))
        pair = np.stack([key // BUCKETS, key % BUCKETS], axis=1)
        of_text = np.unique(np.concatenate([empty, *docs]) * len(vocabulary) + self.words) % max(len(vocabulary), 1)
        texts_of_word = np.bincount(of_text, minlength=len(vocabulary))
        n_sub = np.bincount(pair[:, 0], minlength=len(vocabulary))
        frequent = np.bincount(pair[:, 1], texts_of_word[pair[:, 0]], minlength=BUCKETS) >= min(MIN_TEXTS, len(texts) / 10)
        pair = pair[frequent[pair[:, 1]]]
        used, self.bucket = np.unique(pair[:, 1], return_inverse=True)
        self.used, self.n_vocabulary = used, len(vocabulary)
        self.sub_at = tb.bounds(np.bincount(pair[:, 0], minlength=len(vocabulary)))
        n_words = np.bincount(np.concatenate([empty, *docs]), minlength=len(texts))
        # side by side in training, so that every word is in one window
        first, last, self.text, self.window_at = _windows(n_words, WINDOW)
        self.span_at = np.append(first, last[-1:])
        self.size = (last - first).astype(np.float32)[:, None]
        self.n_sub = np.maximum(n_sub, 1).astype(np.float32)[:, None]

    def window_vectors(self, table: np.ndarray) -> np.ndarray:
        words = tb.group_reduce(np.add, table[self.bucket], self.sub_at, 0) / self.n_sub
        return tb.group_reduce(np.add, words[self.words], self.span_at, 0) / self.size

    def table_gradient(self, of_windows: np.ndarray) -> np.ndarray:
        """Gradient of the bucket table from that of the window vectors."""
        on_word = np.repeat(of_windows / self.size, np.diff(self.span_at), axis=0)
        out = np.empty((len(self.used), on_word.shape[1]), np.float32)
        for d in range(on_word.shape[1]):
            of_vocabulary = np.bincount(self.words, on_word[:, d], minlength=self.n_vocabulary) / self.n_sub[:, 0]
            out[:, d] = np.bincount(self.bucket, np.repeat(of_vocabulary, np.diff(self.sub_at)), minlength=len(self.used))
        return out


def fit(texts: list[str], labels: list[int], prevalence: float | None = None, seed: int = 5) -> Model:
    """Joint training on labelled texts; ``prevalence`` is the toxic share to calibrate for."""
    y = np.array(labels)
    if not len(y) or y.min(initial=1) == y.max(initial=0):
        # nothing to tell apart: the only class's score everywhere, 0 without labels
        return Model(np.zeros(BUCKETS), 0.0, 0.0, 4.0 if len(y) and y[0] else -4.0)
    spare = np.arange(len(y)) % CALIBRATION == CALIBRATION - 1
    if len(set(y[~spare])) < 2 or len(set(y[spare])) < 2:
        spare = np.zeros(len(y), bool)  # too few texts to keep some back
    rng, bags = np.random.RandomState(seed), _Bags([t for t, s in zip(texts, spare) if not s])
    table = (rng.uniform(-1, 1, (len(bags.used), DIM)) / DIM).astype(np.float32)
    soft, bias = (rng.uniform(-1, 1, (DIM, 2)) * 0.5).astype(np.float32), np.zeros(2, np.float32)
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in (table, soft, bias)]
    target = y[~spare][bags.text]
    t = 0
    for phase in range(2):
        weight = np.ones(len(target), np.float32)
        if phase:
            # of toxic texts only windows close to the worst one are known to be toxic
            logit = bags.window_vectors(table) @ (soft[:, 1] - soft[:, 0])
            worst = tb.group_reduce(np.maximum, logit, bags.window_at, -np.inf)[bags.text]
            weight[(target == 1) & (logit < worst - 0.25 * np.abs(worst - np.median(logit)))] = 0
        for label in (0, 1):
            weight[target == label] /= max(weight[target == label].sum(), 1)
        for _ in range(STEPS):
            t += 1
            vectors = bags.window_vectors(table)
            z = vectors @ soft + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(target)), target] -= 1
            p *= weight[:, None]
            grads = (bags.table_gradient(p @ soft.T), vectors.T @ p, p.sum(axis=0))
            for k, (param, grad) in enumerate(zip((table, soft, bias), grads)):
                m, v = state[k]
                m *= 0.9
                m += 0.1 * grad
                v *= 0.99
                v += 0.01 * grad ** 2
                param -= RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-9)
    buckets = np.zeros(BUCKETS)
    buckets[bags.used] = table @ (soft[:, 1] - soft[:, 0])
    model = Model(buckets, float(bias[1] - bias[0]))
    # in-sample words would look too certain, so the calibration sees texts that were not trained on
    judged = spare if spare.any() else np.ones(len(y), bool)
    worst = np.concatenate([model.worst(s) for s in tb.slices(pa.array([t for t, s in zip(texts, judged) if s], pa.string()))])
    model.slope, model.offset = _calibrate(worst, y[judged], prevalence if prevalence is not None else y.mean())
    return model


def _calibrate(x: np.ndarray, y: np.ndarray, prevalence: float) -> tuple[float, float]:
    """Logistic regression of the label on the worst logit, by Newton steps, classes weighted to
    ``prevalence``; a small ridge keeps separable labels finite."""
    w = np.where(y == 1, prevalence / max(y.mean(), 1e-9), (1 - prevalence) / max(1 - y.mean(), 1e-9))
    centre, scale = x.mean(), x.std() + 1e-9
    features = np.stack([(x - centre) / scale, np.ones_like(x)], axis=1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(features @ beta, -40, 40)))
        grad = features.T @ (w * (p - y)) + 0.05 * beta
        hessian = (features * (w * p * (1 - p))[:, None]).T @ features + 0.05 * np.eye(2)
        beta -= np.linalg.solve(hessian, grad)
    return float(beta[0] / scale), float(beta[1] - beta[0] * centre / scale)


def train(docs: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2) -> Model:
    """Fit on at most ``SAMPLE`` texts of each class, those with the smallest hashes of ids."""
    usable = (labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("y"))
              .filter("id is not null and y in (0, 1)").filter(fold(F.col("id"), folds) != held).dropDuplicates(["id"]))
    sizes = {r["y"]: r["n"] for r in usable.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    picked = [usable.filter(F.col("y") == y).orderBy(F.xxhash64(F.col("id").cast("string")), "id").limit(SAMPLE[y]) for y in (0, 1)]
    picked = cut(picked[0].union(picked[1]))
    rows = (docs.select("doc_id", F.col("text").cast("string").alias("text")).join(checked(picked), F.col("doc_id") == F.col("id"))
            .filter((F.length("text") > 0) & (F.length("text") <= MAX_CHARS))
            .select("id", "text", "y").dropDuplicates(["id"]).toPandas().sort_values("id"))
    share = sizes.get(1, 0) / max(sum(sizes.values()), 1)
    return fit(rows.text.tolist(), rows.y.tolist(), share)


def score(docs: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2, threshold: float = 0.3) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score (0 to 1), predicted (score >= threshold).

    Labels of ids whose crc32 modulo ``folds`` is ``held`` are not learned from. Null and empty texts, and
    texts without a word, get the score of no evidence. Null labels and ids teach nothing; with no
    labels, or labels of one class, every text gets the same score. Rows may be repeated; an empty
    table gives no rows; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, folds, held))  # 0.5 MB, fixed

    def run(batches):
        model = shared.value
        for batch in batches:
            for s in tb.slices(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(s.first, s.n), pa.array(model.scores(s))], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select("doc_id", (fold(F.col("doc_id"), folds) == held).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
