"""Linear scorers as plain columns, and their exact attributions."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class LinearModel:
    """Intercept and, per feature, ``(mean, std, coefficient)``."""

    intercept: float
    terms: dict[str, tuple[float, float, float]] = field(default_factory=dict)
    threshold: float = 0.5

    def scaled(self, feature: str) -> Column:
        mean, std, _ = self.terms[feature]
        return (F.col(feature) - F.lit(mean)) / F.lit(std)

    def logit(self) -> Column:
        total = F.lit(self.intercept)
        for feature, (_, _, coef) in self.terms.items():
            total = total + F.lit(coef) * self.scaled(feature)
        return total

    def probability(self) -> Column:
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-self.logit()))

    def matrix_probability(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of a matrix whose columns are the features in the model's order."""
        mean, std, coef = (np.array(v, float) for v in zip(*self.terms.values(), strict=True))
        return 1.0 / (1.0 + np.exp(-(self.intercept + ((x - mean) / std) @ coef)))

    def label(self) -> Column:
        return (self.probability() >= self.threshold).cast("int")

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(f, *map(float, t)) for f, t in self.terms.items()]
        return spark.createDataFrame(rows, "feature string, mean double, std double, coef double")

    def score(self, df: DataFrame) -> DataFrame:
        return df.withColumns({"probability": self.probability(), "label": self.label()})


def long_attributions(
    df: DataFrame, model: LinearModel, background: dict[str, float], keys: list[str]
) -> DataFrame:
    """One row per input row and feature: ``coef * (scaled - background)``.

    For a model that is linear in the log-odds this is the exact Shapley value,
    with ``background`` the mean scaled value of the reference rows.
    """
    entries = F.array(*[
        F.struct(
            F.lit(f).alias("feature"),
            F.col(f).cast("double").alias("value"),
            (F.lit(coef) * (model.scaled(f) - F.lit(background[f]))).alias("attribution"),
        )
        for f, (_, _, coef) in model.terms.items()
    ])
    return df.select(*keys, F.inline(entries))
