"""URL filter: host and path rules first, then logistic regression on hashed character n-grams.

The model is fit in numpy on a small labelled URL table (a parameter; the default is below) and is
one weight vector of fixed size. Scoring is one pass over the URLs without a shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb

BUCKETS = 1 << 13
NGRAMS = (3, 4, 5)
#: Rows of the labelled table that the fit accepts.
MAX_LABELLED = 20_000

#: Site names of the default labelled table; every name is met under three addresses made by rule.
BLOCKED_NAMES = (
    "casino-royal online-casino casino-bonus win-casino lucky-slots free-slots slots-win jackpot-bets sports-bets free-bet-tips bets-online "
    "poker-win cheap-meds cheap-pills-store pills-online buy-pills viagra-cheap cheap-viagra diet-pills replica-watches cheap-watches "
    "adult-cams adult-chat adult-videos xxx-adult hot-singles xxx-videos free-porn porn-tube payday-loans fast-cash-loans easy-money-win win-prizes free-gift-cards "
    "ads-server adserver ads-network ad-tracking tracking-pixel banner-ads popup-ads ads-tracker track-clicks click-track clicktracker adtrack spam-links spam-blast spam-mail spam-site link-farm spamfarm seo-link-farm "
    "crack-keygen free-warez").split()
ALLOWED_NAMES = (
    "weather-report city-library daily-news world-times science-journal open-source garden-notes travel-diary history-museum "
    "math-lectures physics-forum university college school academy library archive encyclopedia dictionary recipes cooking health-clinic "
    "hospital council government parliament court police research institute laboratory observatory theatre cinema orchestra gallery "
    "photos music radio television magazine newspaper herald tribune gazette bulletin letters essays poetry stories novels books "
    "publisher bookshop software developer engineering compiler python linux hardware network database mapping geography climate ocean "
    "forest mountain river farming wildlife birds insects football cricket tennis cycling running swimming chess railways airport harbour "
    "thereon nation another whether together mention station thinner interest other tiger winter enter trade handle read arrest").split()
_PREFIXES, _SUFFIXES = ("", "www.", "blog.", "m."), (".com", ".org", ".net", ".example.com", ".example.org", ".example.net")
_PATHS = ("/", "/en/{}", "/de/{}.html", "/fr/{}/", "/es/{}", "/news/{}", "/en/{}.html")


def default_labelled() -> list[tuple[str, int]]:
    """(url, 1 to block or 0 to allow): name, prefix, ending and path take turns."""
    rows = []
    for label, names in ((1, BLOCKED_NAMES), (0, ALLOWED_NAMES)):
        for i, name in enumerate(names):
            for j in range(3):
                k = 3 * i + j
                rows.append((f"https://{_PREFIXES[k % 4]}{name}{_SUFFIXES[k % 6]}{_PATHS[k % 7].format(17 * k % 991)}", label))
    return rows


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: then up
    to ``?``, ``#`` or the end. Null or without ``://``: both empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """struct(rule, verdict) of the longest fitting rule, else null.

    ``rules`` is a short list of ("allow" or "block", "host/path"). A rule fits its host and all its
    subdomains, if the path starts with the rule's. Of equally long ones the first stands.
    """
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: -len(r[1]))[::-1]:
        at = rule.index("/")
        fits = ((host == rule[:at]) | host.endswith("." + rule[:at])) & path.startswith(rule[at:])
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _features(column: pa.Array, salt: int):
    """(row, bucket) of the character n-grams of each value between two boundary blanks."""
    padded = pc.binary_join_element_wise(" ", column, " ", "")
    rows, buckets = [], []
    for s in tb.slices(padded):
        prefix = tb.prefix_hash(tb.LOWER[s.buf])
        pos = np.arange(len(s.buf))
        row = tb.owner(s.offsets, pos)
        for n in NGRAMS:
            ok = pos + n <= s.offsets[row + 1]
            h = tb.span_hash(prefix, pos[ok], pos[ok] + n)
            rows.append(row[ok] + s.first)
            buckets.append((tb.mix(h + np.uint64(salt)) % np.uint64(BUCKETS)).astype(np.int64))
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *rows]), np.concatenate([empty, *buckets])


def _logits(hosts: pa.Array, paths: pa.Array, weights: np.ndarray) -> np.ndarray:
    """Bias plus the mean weight of the host's n-grams plus that of the path's."""
    out = np.full(len(hosts), weights[-1])
    for salt, column in ((1, hosts), (2, paths)):
        row, bucket = _features(column, salt)
        n = np.bincount(row, minlength=len(out))
        out += np.bincount(row, weights[bucket], minlength=len(out)) / np.sqrt(np.maximum(n, 1))
    return out


def fit(hosts: list[str], paths: list[str], labels: list[int], steps: int = 250, ridge: float = 5e-4) -> np.ndarray:
    """Weights of the n-gram buckets and the bias, by full-batch gradient steps (Adam)."""
    y = np.array(labels, float)
    if not len(y):
        return np.zeros(BUCKETS + 1)
    x = np.zeros((len(y), BUCKETS + 1), np.float64)
    x[:, -1] = 1
    for salt, column in ((1, hosts), (2, paths)):
        row, bucket = _features(pa.array(column, pa.string()), salt)
        n = np.bincount(row, minlength=len(y))
        np.add.at(x, (row, bucket), 1 / np.sqrt(n[row]))
    used = np.flatnonzero(x.any(axis=0))
    dense = x[:, used]
    w, m, v = np.zeros(len(used)), np.zeros(len(used)), np.zeros(len(used))
    for t in range(1, steps + 1):
        grad = dense.T @ (1 / (1 + np.exp(-dense @ w)) - y) / len(y) + ridge * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        w -= 0.05 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    out = np.zeros(BUCKETS + 1)
    out[used] = w
    return out


def judge(pages: DataFrame, rules: list[tuple[str, str]], labelled: DataFrame | None = None) -> DataFrame:
    """One row per input row: page_id, host, path, rule, verdict, score.

    verdict is the longest fitting rule's, else "block" where the model's score (probability to
    block) is at least 0.5. ``labelled`` has (url, label) with label 1 to block, at most
    ``MAX_LABELLED`` rows; null urls or labels are left out. Null, empty and malformed urls have an empty
    host and path, fit no rule and get the model's verdict on empty strings. Ids may be null or
    repeated; other columns are ignored; an empty table gives no rows.
    """
    spark = pages.sparkSession
    if labelled is None:
        labelled = spark.createDataFrame(default_labelled(), "url string, label int")
    rows = (labelled.filter("url is not null and label is not null").orderBy("url", "label").limit(MAX_LABELLED)
            .select(*[c.alias(n) for c, n in zip(host_and_path(F.col("url")), ("host", "path"))], "label").collect())
    weights = fit([r["host"] for r in rows], [r["path"] for r in rows], [r["label"] for r in rows])

    def run(batches):
        for batch in batches:
            score = 1 / (1 + np.exp(-_logits(batch.column("host"), batch.column("path"), weights)))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("host"), batch.column("path"), pa.array(score)],
                                             names=["page_id", "host", "path", "score"])

    host, path = host_and_path(F.col("url").cast("string"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    kind = parts.schema["page_id"].dataType.simpleString()
    scored = parts.mapInArrow(run, f"page_id {kind}, host string, path string, score double")
    rule = matching_rule(F.col("host"), F.col("path"), rules)
    return scored.withColumn("__m", rule).select(
        "page_id", "host", "path", F.col("__m.rule").alias("rule"),
        F.coalesce("__m.verdict", F.when(F.col("score") >= 0.5, "block").otherwise("allow")).alias("verdict"), "score")
