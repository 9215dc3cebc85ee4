"""Estimators with the parameters the jobs use."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import (
    GBTRegressor,
    GeneralizedLinearRegression,
    LinearRegression,
    LinearRegressionModel,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame, functions as F

from millrace.ml.prep import BinIndexer, BinIndexerModel
from millrace.session import cut_lineage

SEED = 42
# Weighted rows that stand for any number of rows in fits of trees.
GATHERED_ROWS = 1 << 20


def linear_regression(label: str, features: str = "scaled", **params: Any) -> LinearRegression:
    return LinearRegression(labelCol=label, featuresCol=features, **params)


def generalized_linear(label: str, features: str = "scaled", **params: Any) -> GeneralizedLinearRegression:
    settings = {"family": "gaussian", "link": "identity", "maxIter": 10, "regParam": 0.3, **params}
    return GeneralizedLinearRegression(labelCol=label, featuresCol=features, **settings)


def boosted_trees(label: str, features: str = "scaled", **params: Any) -> GBTRegressor:
    """Each round's lineage is cut in the shared checkpoint folder every ten rounds."""
    settings = {"maxIter": 10, "seed": SEED, "checkpointInterval": 10, **params}
    return GBTRegressor(labelCol=label, featuresCol=features, **settings)


def fit_boosted(estimator: GBTRegressor, train: DataFrame) -> PipelineModel:
    """Boosted trees of `train` from one weighted row per combination of bins, instead of its rows.

    The trees see no more of a feature than its bin, and of squared errors only the number and the mean label of the rows
    of a bin count: what a mean leaves out is the same for every split. With few features the combinations are bounded
    by the bins (32 to the power of the features), so the rounds cost the same at every size.
    """
    features, label = estimator.getFeaturesCol(), estimator.getLabelCol()
    binned = BinIndexer(features, "_bins", estimator.getMaxBins()).fit(train)
    # A missing label stays missing, and the fit refuses it.
    mean = F.when(F.count(label) == F.count(F.lit(1)), F.avg(F.col(label).cast("double")))
    rows = binned.transform(train).select(vector_to_array("_bins").alias("_bins"), label)
    weighted = rows.groupBy("_bins").agg(F.count(F.lit(1)).cast("double").alias("_weight"), mean.alias(label))
    weighted = cut_lineage(weighted.withColumn("_bins", array_to_vector("_bins")))
    return PipelineModel([binned, estimator.copy().setFeaturesCol("_bins").setWeightCol("_weight").fit(weighted)])


def gather(
    train: DataFrame, features: str, label: str, ids: Sequence[str], *keep: str, bins: int = 32, most: int | None = None
) -> tuple[BinIndexerModel, DataFrame, DataFrame] | None:
    """For fits of trees at the cost of few rows: the bins of the features, `train` with its bins, and weighted rows.

    Trees see no more of a feature than its bin, so rows of one combination of bins (and of the columns `keep`) may stand
    as one, with their number and mean label: all rows count in every sum a split is chosen by. A forest draws its rows
    anew for each tree; so that it has much to draw from, a combination is dealt into random blocks (by a hash of `ids`),
    about `most` (`GATHERED_ROWS`) in all. Drawing blocks moves the mean of a combination as much as drawing its rows does.
    None where that does not pay: up to `most` rows, or with hardly fewer combinations than rows (many fine features).
    Fit with `on_gathered`.
    """
    n, most = train.count(), GATHERED_ROWS if most is None else most
    if n <= most:
        return None
    binned = BinIndexer(features, "_bins", bins).fit(train)
    rows = binned.transform(train)
    combination = [vector_to_array("_bins"), *[F.col(c) for c in keep]]
    combinations = rows.agg(F.approx_count_distinct(F.xxhash64(*combination))).first()[0]
    if 2 * combinations > n:
        return None
    rows = cut_lineage(rows.select("_bins", label, *ids, *keep))
    block = F.pmod(F.xxhash64(*ids, F.lit(SEED)), F.lit(max(1, most // max(1, combinations))))
    # A missing label stays missing, and the fit refuses it.
    mean = F.when(F.count(label) == F.count(F.lit(1)), F.avg(F.col(label).cast("double")))
    weighted = (
        rows.withColumn("_bins", vector_to_array("_bins"))
        .groupBy("_bins", *keep, block.alias("_block"))
        .agg(F.count(F.lit(1)).cast("double").alias("_weight"), mean.alias(label))
        .withColumn("_bins", array_to_vector("_bins"))
        .drop("_block")
    )
    # As many files as cores, as it is small and read again and again.
    return binned, rows, cut_lineage(weighted.repartition(train.sparkSession.sparkContext.defaultParallelism))


def on_gathered(estimator: Any) -> Any:
    """The same estimator of trees, for the weighted rows of `gather`."""
    return estimator.copy().setFeaturesCol("_bins").setWeightCol("_weight")


def forest_regressor(label: str, features: str = "scaled", **params: Any) -> RandomForestRegressor:
    """Rows keep the nodes they are in: else each pass walks all trees from the root and sends them to each task."""
    settings = {"seed": SEED, "cacheNodeIds": True, **params}
    return RandomForestRegressor(labelCol=label, featuresCol=features, **settings)


def logistic_regression(label: str, features: str = "features", **params: Any) -> LogisticRegression:
    settings = {"maxIter": 10, "regParam": 0.001, **params}
    return LogisticRegression(labelCol=label, featuresCol=features, **settings)


def summed_in_one(pieces: int) -> tuple[int, int]:
    """How many partitions, at least `pieces`, and which `aggregationDepth` let executors add up a gradient to one result.

    The library adds up in steps of the root of that number, and most numbers leave two to seven sums, each as long as
    there are features, to the driver. 28, 112, 448, ... partitions are added up four by four to seven, and these to one.
    """
    if pieces <= 1:
        return 1, 2
    steps = 1
    while 7 * 4**steps < pieces:
        steps += 1
    return 7 * 4**steps, steps + 2


def forest_classifier(label: str, features: str = "features", **params: Any) -> RandomForestClassifier:
    return RandomForestClassifier(labelCol=label, featuresCol=features, **{"seed": SEED, **params})


def linear_svm(label: str, features: str = "scaled", **params: Any) -> LinearSVC:
    settings = {"maxIter": 5, "regParam": 0.2, **params}
    return LinearSVC(labelCol=label, featuresCol=features, **settings)


def linear_report(model: LinearRegressionModel, test: DataFrame, digits: int = 6) -> DataFrame:
    """`part, name, value`: coefficients and intercept, then RMSE and r² of training and of test rows.

    As many rows as the model has features.
    """
    measured = model.evaluate(test)
    rows = [("model", f"coefficient_{i}", float(c)) for i, c in enumerate(model.coefficients)]
    rows.append(("model", "intercept", float(model.intercept)))
    for part, summary in (("train", model.summary), ("test", measured)):
        rows.append((part, "rmse", float(summary.rootMeanSquaredError)))
        rows.append((part, "r2", float(summary.r2)))
    report = test.sparkSession.createDataFrame(rows, "part STRING, name STRING, value DOUBLE")
    return report.withColumn("value", F.round("value", digits))


def residuals(predicted: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Observed minus predicted value of each row."""
    return predicted.withColumn("residual", F.col(label) - F.col(prediction))
