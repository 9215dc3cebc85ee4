"""Choosing parameters by cross validation or by one train/validation split."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial
from itertools import chain
from typing import Any

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import Evaluator, RegressionEvaluator
from pyspark.ml.param import Param
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.scalars import unit_hash
from millrace.session import cut_lineage, fills_cores

_KEEPS_ROWS = (GBTRegressor, RandomForestClassifier, RandomForestRegressor)
# Parameters that only a fitted model uses: fits that differ in nothing else are one fit.
_LATE = {"threshold", "thresholds"}


def fold_of(*ids: str, folds: int = 3, seed: int = 42) -> Column:
    """Number of the fold of a row, from a hash of its identity: the same whatever the partitioning."""
    return F.floor(unit_hash(*ids, seed=seed) * folds).cast("int")


def grid(choices: Mapping[Param, Sequence[Any]]) -> list[dict[Param, Any]]:
    """Every combination of the given values."""
    builder = ParamGridBuilder()
    for param, values in choices.items():
        builder = builder.addGrid(param, list(values))
    return builder.build()


def tune(
    estimator: Estimator,
    train: DataFrame,
    param_grid: Sequence[Mapping[Param, Any]],
    evaluator: Evaluator,
    folds: int | None = 3,
    ratio: float = 0.8,
    seed: int = 42,
    parallelism: int | None = None,
    fold_column: str | None = None,
    weighted: DataFrame | None = None,
    pieces: int | None = None,
) -> tuple[Model, DataFrame]:
    """Best model, and `params, metric, best` for each combination.

    `folds` picks cross validation; None picks a single split with `ratio`. With `fold_column` the folds are
    those numbered there (see `fold_of`), so that a fold's measure can be computed again by a plain
    aggregate (a single split holds out fold 0); else they are drawn by `seed`. Pass a written table (`cut_lineage`): every fit reads it again, and
    nothing is kept on executors that could be lost.

    Folds are filters on the written table. The library's own validators copy each fold into memory beside what the
    fits keep there, and their threads share one set of job properties, so that one fit's end may break another.
    By default four fits run side by side, but only one of trees on a table that fills all cores: each keeps its rows.

    `weighted` stands for `train` in the fits (see `models.gather`), with the same folds; measures are of the rows of `train`.
    With `pieces`, the rows of each fit are dealt to so many partitions (see `models.summed_in_one`).
    """
    if weighted is not None and fold_column is None:
        raise ValueError("weighted rows need the folds of the rows they stand for")
    if parallelism is None:
        whole = train if weighted is None else weighted
        parallelism = 1 if isinstance(estimator, _KEEPS_ROWS) and fills_cores(whole) else 4
    if fold_column is None:
        fold_column = "_fold"
        drawn = F.rand(seed)
        number = F.when(drawn < ratio, 1).otherwise(0) if folds is None else F.least(F.floor(drawn * folds), F.lit(folds - 1))
        train = cut_lineage(train.withColumn(fold_column, number.cast("int")))
    fitted = train if weighted is None else weighted

    def dealt(rows: DataFrame) -> DataFrame:
        return rows if pieces is None else rows.repartition(pieces)

    number = F.col(fold_column)
    if folds is not None:
        known = (F.lit(0) <= number) & (number < F.lit(folds))
        number = F.when(known, number).otherwise(F.raise_error(F.lit(f"fold number must be in range [0, {folds})")))
    tasks = []
    for held in range(folds or 1):
        rest, valid = fitted.where(number != held), train.where(number == held)
        if folds is not None and (rest.isEmpty() or valid.isEmpty()):
            raise ValueError(f"no rows to train or to validate fold {held}")
        # Wrapped one by one, so that each has a copy of the job properties to itself.
        tasks += [
            inheritable_thread_target(train.sparkSession)(partial(_measured, estimator, dealt(rest), valid, alike, evaluator))
            for alike in _alike(estimator, param_grid, evaluator)
        ]
    # The fits of all folds share the threads: none waits for the slowest of a fold.
    with ThreadPoolExecutor(parallelism) as pool:
        by_place: dict[int, list[float]] = {}
        for place, metric in chain.from_iterable(pool.map(lambda task: task(), tasks)):
            by_place.setdefault(place, []).append(metric)
    measured = [by_place[place] for place in range(len(param_grid))]
    means = [float(mean) for mean in np.mean(measured, axis=1)]
    place = int((np.argmax if evaluator.isLargerBetter() else np.argmin)(means))
    return estimator.fit(dealt(fitted), param_grid[place]), _report(train, param_grid, means, evaluator.isLargerBetter())


def _by_rounds(estimator: Estimator, evaluator: Evaluator) -> bool:
    """Whether one fit tells the measure after each number of rounds: the first trees of a longer fit are a shorter one."""
    return (
        isinstance(estimator, GBTRegressor)
        and not estimator.isDefined("validationIndicatorCol")
        and isinstance(evaluator, RegressionEvaluator)
        and evaluator.getMetricName() in ("rmse", "mse")
        and not evaluator.isDefined("weightCol")
    )


def _alike(
    estimator: Estimator, param_grid: Sequence[Mapping[Param, Any]], evaluator: Evaluator
) -> list[list[tuple[int, Mapping[Param, Any]]]]:
    """Combinations, with their places, in groups that one fit serves."""
    rounds = {"maxIter"} if _by_rounds(estimator, evaluator) else set()
    groups: dict[tuple, list] = {}
    for place, chosen in enumerate(param_grid):
        key = tuple(sorted((str(p), repr(v)) for p, v in chosen.items() if p.name not in _LATE | rounds))
        groups.setdefault(key, []).append((place, chosen))
    return list(groups.values())


def _measured(
    estimator: Estimator, rest: DataFrame, valid: DataFrame, alike: Sequence[tuple[int, Mapping[Param, Any]]], evaluator: Evaluator
) -> list[tuple[int, float]]:
    """Place and measure of each combination of a group, all from one fit."""
    if len(alike) > 1 and _by_rounds(estimator, evaluator):
        wanted = [estimator.copy(dict(chosen)).getMaxIter() for _, chosen in alike]
        model = estimator.fit(rest, alike[wanted.index(max(wanted))][1])
        columns = [F.col(evaluator.getLabelCol()).cast("double").alias(model.getLabelCol()), model.getFeaturesCol()]
        if model.isDefined("weightCol"):  # the measure is of rows
            columns.append(F.lit(1.0).alias(model.getWeightCol()))
        errors = model.evaluateEachIteration(valid.select(*columns), "squared")
        root = 0.5 if evaluator.getMetricName() == "rmse" else 1.0
        return [(place, errors[rounds - 1] ** root) for (place, _), rounds in zip(alike, wanted)]
    model = estimator.fit(rest, alike[0][1])
    return [(place, evaluator.evaluate(model.copy(dict(chosen)).transform(valid))) for place, chosen in alike]


def _report(
    df: DataFrame, param_grid: Sequence[Mapping[Param, Any]], metrics: Sequence[float], larger: bool
) -> DataFrame:
    best = (max if larger else min)(metrics)
    place = list(metrics).index(best)
    rows = [
        (", ".join(sorted(f"{p.name}={v}" for p, v in chosen.items())), float(metric), number == place)
        for number, (chosen, metric) in enumerate(zip(param_grid, metrics))
    ]
    report = df.sparkSession.createDataFrame(rows, "params STRING, metric DOUBLE, best BOOLEAN")
    return report
