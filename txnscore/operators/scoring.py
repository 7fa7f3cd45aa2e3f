"""Scores and flags (ML2, PR8-PR10) in the column layout MLlib tree ensembles produce."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import class1_probability, fraud_flag, high_risk_flag, probability_from_margin


def score_from_margin(df: DataFrame, margin: str = "margin") -> DataFrame:
    """ML2: ``rawPrediction = [-m, m]``, ``probability = [1/(1+e^{2m}), 1/(1+e^{-2m})]`` and
    ``prediction = argmax`` (class 0 on a tie), as a logistic-loss GBT model emits them."""
    m = F.col(margin)
    return df.withColumns({
        "rawPrediction": array_to_vector(F.array(-m, m)),
        "probability": array_to_vector(F.array(probability_from_margin(-m), probability_from_margin(m))),
        "prediction": F.when(m > 0, F.lit(1.0)).otherwise(F.lit(0.0)),
    })


def with_score_flags(df: DataFrame, prediction: str = "prediction", probability: str = "probability") -> DataFrame:
    """PR8-PR10: ``predicted_fraud`` (prediction = 1), ``fraud_probability`` (class-1 element of
    the probability vector) and ``is_high_risk`` (strictly above 0.4). The vector is kept."""
    p1 = class1_probability(probability)
    return df.withColumns({
        "predicted_fraud": fraud_flag(prediction),
        "fraud_probability": p1,
        "is_high_risk": high_risk_flag(p1),
    })
