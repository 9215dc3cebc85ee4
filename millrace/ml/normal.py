"""Linear models by their normal equations: one aggregate over the rows, a small system on the driver.

A check of iterative solvers, and a model of its own where there are few features: sums of products are
partial aggregates, so any number of rows gives one row of (features + 1)² numbers.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class LinearModel:
    """Coefficients by feature, and the intercept."""

    features: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float

    def predict(self) -> Column:
        """The prediction as an expression, without a pass through a model."""
        total = F.lit(self.intercept)
        for name, weight in zip(self.features, self.coefficients):
            total = total + F.col(name) * F.lit(weight)
        return total

    def transform(self, df: DataFrame, prediction: str = "prediction") -> DataFrame:
        return df.withColumn(prediction, self.predict())


def moments(df: DataFrame, features: Sequence[str], label: str) -> tuple[np.ndarray, np.ndarray, int]:
    """Means and covariances (population) of features and label, and the number of complete rows."""
    columns = [F.col(c).cast("double") for c in (*features, label)]
    places = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    complete = df.where(~F.greatest(*[c.isNull() | F.isnan(c) for c in columns], F.lit(False)))
    row = complete.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(c).alias(f"mean_{i}") for i, c in enumerate(columns)],
        *[F.covar_pop(columns[i], columns[j]).alias(f"cov_{i}_{j}") for i, j in places],
    ).first()
    means = np.array([row[f"mean_{i}"] for i in range(len(columns))], dtype=float)
    covariances = np.zeros((len(columns), len(columns)))
    for i, j in places:
        covariances[i, j] = covariances[j, i] = row[f"cov_{i}_{j}"] if row["n"] else 0.0
    return means, covariances, row["n"]


def fit_linear(df: DataFrame, features: Sequence[str], label: str, ridge: float = 0.0) -> LinearModel:
    """Least squares with an intercept, and with a penalty as the library's linear models have it.

    The penalty is `ridge` over the deviation of the label times the variance of each feature, so it does not
    depend on the units of either. Features that depend on each other share their weight (least norm).
    Rows with a missing value are left out; a table without rows has no model.
    """
    means, covariances, n = moments(df, features, label)
    if not n:
        raise ValueError("no complete rows to fit")
    p = len(features)
    spread = np.sqrt(covariances[p, p])
    penalty = ridge / spread if ridge and spread else 0.0
    system = covariances[:p, :p] + penalty * np.diag(np.diag(covariances)[:p])
    weights = np.linalg.lstsq(system, covariances[:p, p], rcond=1e-12)[0]
    return LinearModel(tuple(features), tuple(weights.tolist()), float(means[p] - weights @ means[:p]))


def model_table(df: DataFrame, model: LinearModel) -> DataFrame:
    """`name, value`: a row per feature and one for the intercept."""
    rows = [*zip(model.features, model.coefficients), ("intercept", model.intercept)]
    return df.sparkSession.createDataFrame(rows, "name STRING, value DOUBLE")
