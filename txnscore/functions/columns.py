"""Scalar column expressions shared by batch and streaming code.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so it stays inside
whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import (BAND_CRIT, BAND_WARN, BASE_EPOCH_SECONDS, FRAUD_PREDICTION,
                      HIGH_RISK_THRESHOLD, SECONDS_PER_DAY)


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round6(c: str | Column) -> Column:
    """Round to 6 decimals so float sums agree regardless of aggregation order."""
    return F.round(_c(c), 6)


def event_timestamp(offset_seconds: str | Column, base: int = BASE_EPOCH_SECONDS) -> Column:
    """Base epoch plus an offset in seconds, widened to long before adding (ANSI-safe)."""
    return F.lit(base).cast("long") + _c(offset_seconds).cast("long")


def event_time(event_timestamp: str | Column) -> Column:
    """The numeric event timestamp (epoch seconds) as a TIMESTAMP_NTZ for windows and ranges; fractions of a
    second are cut, a null stays null."""
    return ntz_from_epoch_seconds(F.floor(_c(event_timestamp)).cast("long"))


def entity_key(card: str | Column, addr: str | Column, offset_seconds: str | Column,
               day_offset: str | Column) -> Column:
    """``card _ addr _ floor(offset/86400 - day_offset)``, e.g. ``10409_170.0_-206``."""
    day = _c(offset_seconds) / F.lit(SECONDS_PER_DAY)
    return F.concat_ws("_", _c(card).cast("string"), _c(addr).cast("string"),
                       F.floor(day - _c(day_offset)).cast("string"))


EPOCH_NTZ = "1970-01-01 00:00:00"


def epoch_seconds(ts: str | Column) -> Column:
    """Whole seconds from 1970-01-01 to a TIMESTAMP_NTZ wall-clock value (read as UTC). Pure
    NTZ arithmetic, so the result does not depend on the session time zone."""
    return F.timestamp_diff("SECOND", F.lit(EPOCH_NTZ).cast("timestamp_ntz"), _c(ts))


def ntz_from_epoch_seconds(seconds: str | Column) -> Column:
    """Inverse of ``epoch_seconds``: TIMESTAMP_NTZ, independent of the session time zone."""
    return F.timestamp_add("SECOND", _c(seconds), F.lit(EPOCH_NTZ).cast("timestamp_ntz"))


def probability_from_margin(margin: str | Column) -> Column:
    """Class-1 probability of a logistic-loss tree ensemble: 1 / (1 + exp(-2 m))."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * _c(margin)))


def class1_probability(probability_vector: str | Column) -> Column:
    """Element 1 of an MLlib probability vector; null if the vector is null or shorter."""
    return F.get(vector_to_array(_c(probability_vector)), 1)


def fraud_flag(prediction: str | Column) -> Column:
    """True when the prediction is the fraud class; null prediction is not fraud."""
    return F.coalesce(_c(prediction) == F.lit(FRAUD_PREDICTION), F.lit(False))


def high_risk_flag(probability: str | Column, threshold: float = HIGH_RISK_THRESHOLD) -> Column:
    """Strictly above the threshold; exactly 0.4 or null is not high risk."""
    return F.coalesce(_c(probability) > F.lit(threshold), F.lit(False))


def approval_rate(n: str | Column, n_fraud: str | Column) -> Column:
    """(n - fraud) / n as double; null when n is 0 (the gauge then keeps its previous value)."""
    return (_c(n) - _c(n_fraud)).cast("double") / F.nullif(_c(n), F.lit(0)).cast("double")


def threshold_band(value: str | Column, warn: float = BAND_WARN, crit: float = BAND_CRIT) -> Column:
    """green below ``warn``, yellow from ``warn``, red from ``crit``."""
    v = _c(value)
    return (F.when(v >= F.lit(crit), F.lit("red"))
            .when(v >= F.lit(warn), F.lit("yellow"))
            .when(v.isNotNull(), F.lit("green")))


def hash_fraction(key: str | Column, seed: int = 0) -> Column:
    """Deterministic pseudo-uniform value in [0, 1): the first 8 hex digits of md5("key:seed") / 2^32.
    All bits of the key count, so ids that share low or high bits spread as well as any others;
    a null key counts as the empty string."""
    text = F.concat(F.coalesce(_c(key).cast("string"), F.lit("")), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
