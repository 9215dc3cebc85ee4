"""Evaluation of predictions, each in as few passes as the measure allows."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

from pyspark.sql import DataFrame, functions as F

from millrace.operators.order import average_ranks, running_total
from millrace.session import cut_lineage


def regression_metrics(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """One row `mse, rmse, mae, r2, rmsle, log_rmse`, in one aggregate.

    `rmsle` compares logarithms of 1 + value (null unless all values exceed -1); `log_rmse` is
    the natural logarithm of `rmse`.
    """
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    error = y - p
    logs = F.when((y > -1) & (p > -1), F.log1p(p) - F.log1p(y))
    sums = df.agg(
        F.avg(error * error).alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        F.var_pop(y).alias("_variance"),
        F.avg(logs * logs).alias("_log"),
        F.count(logs).alias("_logged"),
        F.count("*").alias("_rows"),
    )
    return sums.select(
        "mse",
        F.sqrt("mse").alias("rmse"),
        "mae",
        (F.lit(1.0) - F.try_divide("mse", "_variance")).alias("r2"),
        F.when(F.col("_logged") == F.col("_rows"), F.sqrt("_log")).alias("rmsle"),
        F.when(F.col("mse") > 0, F.log(F.sqrt("mse"))).alias("log_rmse"),
    )


def confusion(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """`label, prediction, n`."""
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count("*").alias("n")
    )


def classification_metrics(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """One row `precision, recall, accuracy`; the first two weighted by class size.

    The rows are read once; everything else works on the confusion matrix.
    """
    cells = confusion(df, label, prediction)
    per_class = (
        cells.select(
            F.explode(
                F.array(
                    F.struct(
                        F.col("label").cast("double").alias("cls"),
                        F.col("n").alias("actual"),
                        F.lit(0).cast("bigint").alias("predicted"),
                        F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hit"),
                    ),
                    F.struct(
                        F.col("prediction").cast("double").alias("cls"),
                        F.lit(0).cast("bigint").alias("actual"),
                        F.col("n").alias("predicted"),
                        F.lit(0).cast("bigint").alias("hit"),
                    ),
                )
            ).alias("cell")
        )
        .groupBy("cell.cls")
        .agg(*[F.sum(f"cell.{name}").alias(name) for name in ("actual", "predicted", "hit")])
    )
    share = F.coalesce(F.try_divide("hit", "predicted"), F.lit(0.0)) * F.col("actual")
    return per_class.agg(
        F.try_divide(F.sum(share), F.sum("actual")).alias("precision"),
        F.try_divide(F.sum("hit"), F.sum("actual")).alias("recall"),
        F.try_divide(F.sum("hit"), F.sum("actual")).alias("accuracy"),
    )


def auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row `auc`: exact area under the ROC curve, tied scores counting half.

    Rows are counted per distinct score first, so neither a frequent score nor the whole
    ordering ends up in one task.
    """
    counted = df.groupBy(score).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) != 1).alias("_neg")
    )
    ranked = running_total(counted, [score], {"_below": "_neg"})
    beaten = F.col("_pos") * (F.col("_below") - F.col("_neg") / F.lit(2.0))
    return ranked.agg(
        F.try_divide(
            F.sum(beaten), F.sum("_pos").cast("double") * F.sum("_neg").cast("double")
        ).alias("auc")
    )


def correlation(df: DataFrame, columns: Sequence[str], method: str = "pearson") -> DataFrame:
    """`i, j, corr` for all pairs of columns, from a single aggregate over the rows.

    "spearman" correlates ranks, equal values sharing their mean rank. Rows with a missing value in any
    of the columns are left out of both methods, before ranking.
    """
    columns = list(columns)
    df = df.select(*[F.col(column).cast("double").alias(column) for column in columns]).dropna()
    if method == "spearman":
        ranks = average_ranks(df, columns)
        for place, column in enumerate(columns):
            # Written, so that the ranks of a column of few values are known to be small and broadcast;
            # in a column of many values no value is frequent.
            own = cut_lineage(
                ranks.where(F.col("place") == place).select(F.col("value").alias(column), F.col("rank").alias(f"_rank_{column}"))
            )
            df = df.join(own, column)
        inputs = {column: F.col(f"_rank_{column}") for column in columns}
    else:
        inputs = {column: F.col(column) for column in columns}
    pairs = [(a, b) for n, a in enumerate(columns) for b in columns[n + 1 :]]
    measured = df.agg(*[F.corr(inputs[a], inputs[b]).alias(f"{a}|{b}") for a, b in pairs])
    cells = []
    for a, b in product(columns, columns):
        if a == b:
            value = F.lit(1.0)
        else:
            value = F.col(f"`{a}|{b}`" if (a, b) in pairs else f"`{b}|{a}`")
        cells.append(F.struct(F.lit(a).alias("i"), F.lit(b).alias("j"), value.alias("corr")))
    return measured.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")
