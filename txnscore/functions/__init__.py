"""Column expressions (JVM-side built-ins only)."""

from .columns import (  # noqa: F401
    approval_rate, class1_probability, entity_key, epoch_seconds, event_timestamp, hash_fraction, fraud_flag,
    high_risk_flag, ntz_from_epoch_seconds, probability_from_margin, round6, threshold_band,
)
