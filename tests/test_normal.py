"""Normal equations, fixed folds, joined indexes and quantile sketches."""

import random

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from millrace.ml import models, normal, prep, tuning
from millrace.operators import order, text


@pytest.fixture(scope="module")
def rows(spark):
    draw = random.Random(1)
    made = []
    for i in range(800):
        x, z = draw.gauss(0, 3), draw.random() * 100
        made.append((i, x, z, 2.5 * x - 0.3 * z + draw.gauss(0, 4)))
    return spark.createDataFrame(made, "id INT, x DOUBLE, z DOUBLE, y DOUBLE").repartition(4)


@pytest.mark.parametrize("ridge", [0.0, 0.3, 5.0])
def test_normal_equations_equal_the_library(rows, ridge):
    features = prep.assemble(["x", "z"]).transform(rows)
    own = normal.fit_linear(rows, ["x", "z"], "y", ridge)
    for estimator in (models.linear_regression("y", "features", regParam=ridge), models.generalized_linear("y", "features", regParam=ridge)):
        fitted = estimator.fit(features)
        assert own.coefficients == pytest.approx(fitted.coefficients.toArray().tolist(), rel=1e-8)
        assert own.intercept == pytest.approx(fitted.intercept, rel=1e-8, abs=1e-8)
    assert own.transform(rows).where("prediction IS NULL").count() == 0


def test_normal_equations_of_awkward_rows(spark, rows):
    doubled = rows.withColumn("same", F.col("x")).withColumn("fixed", F.lit(3.0))
    own = normal.fit_linear(doubled, ["x", "same", "fixed"], "y")
    assert own.coefficients[0] == pytest.approx(own.coefficients[1]) and own.coefficients[2] == pytest.approx(0.0, abs=1e-6)
    holes = rows.withColumn("x", F.when(F.col("id") % 2 == 0, F.col("x")).otherwise(float("nan")))
    whole = normal.fit_linear(rows.where("id % 2 = 0"), ["x", "z"], "y")
    assert normal.fit_linear(holes, ["x", "z"], "y").coefficients == pytest.approx(whole.coefficients)
    with pytest.raises(ValueError):
        normal.fit_linear(rows.limit(0), ["x"], "y")


def test_fixed_folds_give_the_same_metrics(rows):
    features = prep.assemble(["x", "z"]).transform(rows).withColumn("fold", tuning.fold_of("id", folds=3))
    assert {r[0] for r in features.select("fold").distinct().collect()} == {0, 1, 2}
    estimator = models.linear_regression("y", "features")
    grid, evaluator = tuning.grid({estimator.regParam: [0.0, 2.0]}), RegressionEvaluator(labelCol="y")
    again = [tuning.tune(estimator, f, grid, evaluator, 3, fold_column="fold")[1].collect() for f in (features, features.repartition(7))]
    assert [r["metric"] for r in again[0]] == pytest.approx([r["metric"] for r in again[1]])
    best, single = tuning.tune(estimator, features, grid, evaluator, None, fold_column="fold")
    held = normal.fit_linear(features.where("fold <> 0"), ["x", "z"], "y").transform(features.where("fold = 0"))
    assert single.collect()[0]["metric"] == pytest.approx(evaluator.evaluate(held))
    assert best.coefficients[0] == pytest.approx(normal.fit_linear(rows, ["x", "z"], "y").coefficients[0])


def test_joined_index_equals_the_indexer(spark):
    train = spark.createDataFrame([("b",), ("a",), ("b",), (None,), ("c",)], "name STRING")
    test = spark.createDataFrame([("a",), ("b",), ("new",), (None,), ("c",)], "name STRING")
    joined = prep.JoinIndexer("name", "place").fit(train).transform(test)
    known = prep.index_strings("name", "place").fit(train).transform(test)
    assert sorted(map(str, joined.collect())) == sorted(map(str, known.collect()))
    # A clashing column is replaced.
    assert prep.JoinIndexer("name", "place").fit(train).transform(test.withColumn("place", F.lit(9.0))).columns == ["name", "place"]


def test_sketches_merge_within_their_error(spark):
    draw = random.Random(2)
    values = [draw.expovariate(1) if n % 3 else 1.0 for n in range(20_000)]  # a third of the rows are one value
    frame = spark.createDataFrame([(n % 7, v) for n, v in enumerate(values)] + [(0, None)], "day INT, v DOUBLE")
    found = order.sketched_quantiles(order.quantile_sketches(frame, ["day"], "v"), [0.1, 0.5, 0.99]).collect()
    for row in found:
        assert row["n"] == 20_000
        below, upto = sum(v < row["value"] for v in values) / 20_000, sum(v <= row["value"] for v in values) / 20_000
        assert below - order.rank_error() <= row["share"] <= upto + order.rank_error()


@pytest.mark.parametrize("form", ["set", "postings"])
def test_large_words_are_split_in_blocks(spark, form):
    lines = [(f"f{n:03d}", "hot" + (" cold" if n % 50 == 0 else "") + (" hot" if n % 2 else "")) for n in range(200)]
    frame = spark.createDataFrame(lines, "file STRING, value STRING")
    index = text.inverted_index(frame, form=form, files_per_row=30).collect()
    hot = sorted((r for r in index if r["word"] == "hot"), key=lambda r: r["block"])
    assert [r["block"] for r in hot] == list(range(7)) and {r["n"] for r in hot} == {300}
    listed = [x for r in hot for x in (r["files"] if form == "set" else r["postings"].split(";"))]
    assert [x.split(":")[0] for x in listed] == [f for f, _ in lines]
    assert [(r["block"], r["n"]) for r in index if r["word"] == "cold"] == [(0, 4)]
