import math
import random
import threading
import time
from itertools import product

import pytest
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    MulticlassClassificationEvaluator,
    RegressionEvaluator,
)
from pyspark.ml.feature import StopWordsRemover
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame, functions as F

from millrace.ml import metrics, models, prep, tuning
from millrace.operators import tables as O
from millrace.plans import learning
from millrace.plans.learning import STOP_WORDS
from millrace.session import cut_lineage


@pytest.fixture(scope="module")
def scored(spark):
    draw = random.Random(5)
    # A third of the rows share one score.
    rows = [
        (float(draw.random() < 0.4), 0.5 if n % 3 == 0 else round(draw.random(), 2), float(draw.random() < 0.5))
        for n in range(900)
    ]
    return spark.createDataFrame(rows, "label DOUBLE, score DOUBLE, prediction DOUBLE").repartition(5)


def test_auc_equals_the_evaluator(scored):
    expected = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(scored)
    assert math.isclose(metrics.auc(scored, "label", "score").first()["auc"], expected, rel_tol=1e-12)


def test_weighted_metrics_equal_the_evaluator(scored):
    got = metrics.classification_metrics(scored, "label").first()
    for name, metric in (("precision", "weightedPrecision"), ("recall", "weightedRecall"), ("accuracy", "accuracy")):
        assert math.isclose(got[name], MulticlassClassificationEvaluator(metricName=metric).evaluate(scored), rel_tol=1e-12)


def test_regression_metrics_equal_the_evaluator(scored):
    frame = scored.select((F.col("score") * 3).alias("label"), F.col("score").alias("prediction"))
    got = metrics.regression_metrics(frame, "label").first()
    for name in ("mse", "rmse", "mae", "r2"):
        assert math.isclose(got[name], RegressionEvaluator(metricName=name).evaluate(frame), rel_tol=1e-9)
    assert math.isclose(got["log_rmse"], math.log(got["rmse"]))
    below = frame.withColumn("prediction", F.lit(-2.0))
    assert metrics.regression_metrics(below, "label").first()["rmsle"] is None


@pytest.mark.parametrize("method", ["pearson", "spearman"])
def test_correlation_equals_the_library(scored, method):
    assembled = prep.assemble(["label", "score", "prediction"]).transform(scored)
    matrix = Correlation.corr(assembled, "features", method).first()[0].toArray()
    names = ["label", "score", "prediction"]
    for row in metrics.correlation(scored, names, method).collect():
        assert math.isclose(row["corr"], matrix[names.index(row["i"])][names.index(row["j"])], abs_tol=1e-9)


def test_stop_words_are_the_library_list(spark):
    assert STOP_WORDS == StopWordsRemover.loadDefaultStopWords("english")


def test_unseen_category_gets_its_own_index(spark):
    fitted = prep.index_strings("k", "i").fit(spark.createDataFrame([("N",), ("N",), ("Y",)], "k STRING"))
    got = {r["k"]: r["i"] for r in fitted.transform(spark.createDataFrame([("N",), ("Y",), ("?",)], "k STRING")).collect()}
    assert got == {"N": 0.0, "Y": 1.0, "?": 2.0}


def test_index_table_equals_the_indexer(spark):
    frame = spark.createDataFrame([(w,) for w in "b a c a b d b".split()], "k STRING")
    fitted = prep.index_strings("k", "i").fit(frame)
    assert [r["k"] for r in prep.index_table(frame, "k").orderBy("index").collect()] == list(fitted.labels)


def test_accents_split_words(spark):
    frame = spark.createDataFrame([("Aé b  The dog",)], "text STRING")
    words = prep.remove_stop_words().transform(prep.tokenize().transform(frame)).first()
    assert words["words"] == ["a", "b", "the", "dog"] and words["filtered"] == ["b", "dog"]


def test_grid_and_best_parameters(spark):
    frame = spark.createDataFrame(
        [(float(n), Vectors.dense([float(n)])) for n in range(100)], ["y", "features"]
    )
    estimator = models.linear_regression("y", "features")
    choices = tuning.grid({estimator.regParam: [0.0, 50.0], estimator.maxIter: [5, 10]})
    assert len(choices) == 4
    evaluator = RegressionEvaluator(labelCol="y")
    for folds in (2, None):
        best, report = tuning.tune(estimator, frame, choices, evaluator, folds=folds)
        chosen = report.where("best").collect()
        assert len(chosen) == 1 and "regParam=0.0" in chosen[0]["params"]
        assert best.getRegParam() == 0.0


def test_linear_report_tells_training_and_test_apart(spark):
    train = spark.createDataFrame([(2.0 * n + 1, Vectors.dense([float(n)])) for n in range(50)], ["y", "features"])
    test = spark.createDataFrame([(2.0 * n + 2, Vectors.dense([float(n)])) for n in range(50)], ["y", "features"])
    report = {(r["part"], r["name"]): r["value"] for r in models.linear_report(
        models.linear_regression("y", "features").fit(train), test).collect()}
    assert report[("model", "coefficient_0")] == 2.0 and report[("model", "intercept")] == 1.0
    assert report[("train", "rmse")] == 0.0 and report[("test", "rmse")] == 1.0


def test_frequent_terms_are_those_of_the_vectorizer(spark):
    draw = random.Random(8)
    rows = [(n, [f"w{int(draw.random() ** 2 * 30)}" for _ in range(20)]) for n in range(60)]
    frame = spark.createDataFrame(rows, "id INT, filtered ARRAY<STRING>").repartition(4)
    fitted = prep.count_terms(min_docs=20.0).fit(frame)
    terms = prep.frequent_terms(frame, "id", min_docs=20)
    assert set(terms) == set(fitted.vocabulary) and 0 < len(terms) < 30
    assert prep.frequent_terms(frame, "id", size=3, min_docs=1) == terms[:3]
    places, counts = prep.sparse_entries("features")
    counted = prep.count_known_terms(terms).transform(frame).select("id", places.alias("p"), counts.alias("c"))
    by_id = dict(rows)
    for row in counted.collect():
        assert {terms[p]: c for p, c in zip(row["p"], row["c"])} == {
            t: by_id[row["id"]].count(t) for t in set(by_id[row["id"]]) & set(terms)
        }


def test_components_project_like_the_eigenvectors(spark):
    import numpy

    draw = random.Random(2)
    points = numpy.array([[draw.random(), draw.random() * 3, draw.random() * 0.2] for _ in range(80)])
    frame = spark.createDataFrame([(Vectors.dense(p),) for p in points.tolist()], ["scaled"])
    got = numpy.array([r["reduced"].toArray() for r in prep.reduce(2).fit(frame).transform(frame).collect()])
    _, vectors = numpy.linalg.eigh(numpy.cov(points.T))
    expected = points @ vectors[:, ::-1][:, :2]
    assert numpy.allclose(numpy.abs(got), numpy.abs(expected), atol=1e-8)


@pytest.mark.parametrize("method", ["pearson", "spearman"])
def test_correlation_takes_complete_rows(spark, method):
    data = [(1.0, 2.0, 5.0), (2.0, 1.0, None), (3.0, 5.0, 1.0), (4.0, 4.0, 4.0), (None, 9.0, 9.0), (6.0, 7.0, 2.0)]
    df = spark.createDataFrame(data, "a DOUBLE, b DOUBLE, c DOUBLE")
    got = {(r["i"], r["j"]): r["corr"] for r in metrics.correlation(df, ["a", "b", "c"], method).collect()}
    wanted = df.toPandas().dropna().corr(method)
    assert all(abs(value - wanted.loc[i, j]) < 1e-9 for (i, j), value in got.items())


def folded_line(spark, n=90):
    return spark.createDataFrame([(3.0 * k, Vectors.dense([float(k), k % 7.0]), k % 3) for k in range(n)], ["y", "scaled", "fold"])


class Marking(Estimator):
    """Leaves a mark in the job properties of its thread and fits once the others had time to leave theirs."""

    def __init__(self, inner):
        super().__init__()
        self.inner = inner

    def _fit(self, dataset):
        context = dataset.sparkSession.sparkContext
        mark = str(threading.get_ident())
        context.setLocalProperty("mark", mark)
        time.sleep(0.5)
        assert context.getLocalProperty("mark") == mark
        return self.inner.fit(dataset)

    def fit(self, dataset, params=None):
        return self._fit(dataset)


def test_fits_side_by_side_share_no_job_properties_and_keep_no_fold(spark, monkeypatch):
    frame = folded_line(spark)
    inner = models.linear_regression("y")
    choices = tuning.grid({inner.regParam: [0.0, 0.1, 0.2, 0.3]})
    monkeypatch.setattr(DataFrame, "cache", lambda self: pytest.fail("a fold is kept in memory"))
    monkeypatch.setattr(DataFrame, "persist", lambda self, *level: pytest.fail("a fold is kept in memory"))
    _, report = tuning.tune(Marking(inner), frame, choices, RegressionEvaluator(labelCol="y"), folds=3, fold_column="fold")
    assert report.count() == 4
    for wrong in (3, None):
        odd = frame.withColumn("fold", F.when(F.col("y") > 30, F.col("fold")).otherwise(F.lit(wrong).cast("int")))
        with pytest.raises(Exception, match="fold number|ERROR"):
            tuning.tune(inner, odd, choices, RegressionEvaluator(labelCol="y"), folds=3, fold_column="fold")


def test_combinations_of_one_fit_measure_like_fits_of_their_own(spark):
    frame = folded_line(spark).withColumn("y", F.col("y") * F.when(F.col("fold") == 1, 1.1).otherwise(1.0))
    trees = models.boosted_trees("y")
    evaluator = RegressionEvaluator(labelCol="y")
    choices = tuning.grid({trees.maxIter: [2, 5, 3], trees.maxDepth: [1, 2]})
    assert sorted(len(alike) for alike in tuning._alike(trees, choices, evaluator)) == [3, 3]
    _, report = tuning.tune(trees, frame, choices, evaluator, folds=None, fold_column="fold")
    for row, chosen in zip(report.collect(), choices):
        model = trees.fit(frame.where("fold <> 0"), chosen)
        assert math.isclose(row["metric"], evaluator.evaluate(model.transform(frame.where("fold = 0"))), rel_tol=1e-9)
    classes = frame.withColumn("y", (F.col("y") % 4 > 1).cast("double"))
    logistic = models.logistic_regression("y", "scaled")
    f1 = MulticlassClassificationEvaluator(labelCol="y", metricName="f1")
    choices = tuning.grid({logistic.maxIter: [3, 6], logistic.threshold: [0.3, 0.6, 0.5]})
    assert sorted(len(alike) for alike in tuning._alike(logistic, choices, f1)) == [3, 3]
    best, report = tuning.tune(logistic, classes, choices, f1, folds=3, fold_column="fold")
    for row, chosen in zip(report.collect(), choices):
        own = [f1.evaluate(logistic.fit(classes.where(f"fold <> {k}"), chosen).transform(classes.where(f"fold = {k}"))) for k in range(3)]
        assert math.isclose(row["metric"], sum(own) / 3, rel_tol=1e-9)
    assert f"threshold={best.getThreshold()}" in report.where("best").first()["params"]


def test_boosting_on_weighted_bins_is_boosting_on_rows(spark, monkeypatch):
    draw = random.Random(4)
    rows = [([float(draw.randrange(9)), draw.randrange(5) / 7, -float(draw.randrange(3))], draw.random() * 9) for _ in range(1500)]
    frame = spark.createDataFrame([(Vectors.dense(x), x[0] * x[1] + x[2] + y) for x, y in rows], ["scaled", "y"]).repartition(3)
    trees = models.boosted_trees("y", maxIter=4, maxDepth=3)
    fitted = []
    monkeypatch.setattr(type(trees), "_fit_java", lambda self, df, real=type(trees)._fit_java: fitted.append(df) or real(self, df))
    model = models.fit_boosted(trees, frame)
    assert fitted[0].count() <= 9 * 5 * 3 and fitted[0].agg(F.sum("_weight")).first()[0] == 1500
    theirs = trees.fit(frame).transform(frame).withColumnRenamed("prediction", "theirs")
    assert model.transform(theirs).where(F.abs(F.col("prediction") - F.col("theirs")) > 1e-6).isEmpty()
    missing = frame.withColumn("y", F.when(F.col("y") < 5, F.col("y")))
    with pytest.raises(Exception):
        models.fit_boosted(trees, missing)


def test_bins_are_bounded(spark):
    frame = spark.createDataFrame([(Vectors.dense([n / 3.0, n % 4]),) for n in range(999)], ["scaled"])
    bins = prep.BinIndexer("scaled", "b", 8).fit(frame).transform(frame).select(vector_to_array("b").alias("b"))
    sizes = [r["count"] for r in bins.groupBy(F.col("b")[0]).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 140 and bins.select(F.col("b")[1]).distinct().count() == 4


def test_trees_of_gathered_rows_are_trees_of_all_rows(spark):
    rows = spark.range(6000).select(
        "id", F.array((F.col("id") % 5).cast("double"), (F.col("id") % 7).cast("double")).alias("x"), (F.col("id") % 3).cast("int").alias("fold")
    )
    rows = rows.withColumn("y", F.col("x")[0] * 10 + F.col("x")[1] ** 2 + F.pmod(F.xxhash64("id"), F.lit(9)))
    rows = cut_lineage(rows.withColumn("scaled", array_to_vector("x")).select("id", "scaled", "y", "fold"))
    assert models.gather(rows, "scaled", "y", ["id"], "fold", most=6000) is None
    assert models.gather(rows.select("id", F.lit(0).alias("fold"), "y", array_to_vector(F.array(F.rand(1), F.rand(2), F.rand(3))).alias("scaled")),
                         "scaled", "y", ["id"], "fold", most=100) is None
    binned, with_bins, weighted = models.gather(rows, "scaled", "y", ["id"], "fold", most=500)
    assert weighted.count() <= 1000 and with_bins.count() == 6000
    for fold in range(3):  # no row is lost, and every row counts once
        mine, all_rows = (df.where(F.col("fold") == fold) for df in (weighted, rows))
        n, total = mine.agg(F.sum("_weight"), F.sum(F.col("_weight") * F.col("y"))).first()
        assert n == all_rows.count() and total == pytest.approx(all_rows.agg(F.sum("y")).first()[0])
    evaluator = RegressionEvaluator(labelCol="y")
    forest, boosted = models.forest_regressor("y", numTrees=10), models.boosted_trees("y", maxDepth=3)
    for estimator, choices in ((forest, tuning.grid({forest.maxDepth: [3, 5]})), (boosted, tuning.grid({boosted.maxIter: [2, 4]}))):
        model, report = tuning.tune(estimator, rows, choices, evaluator, fold_column="fold")
        grouped, near = tuning.tune(
            models.on_gathered(estimator), with_bins, choices, evaluator, fold_column="fold", weighted=weighted
        )
        # The measures are of rows, so the spread of labels within a combination is in them.
        pairs = zip(report.orderBy("params").collect(), near.orderBy("params").collect())
        assert all(a["metric"] == pytest.approx(b["metric"], rel=0.1) for a, b in pairs)
        errors = [evaluator.evaluate(m.transform(df)) for m, df in ((model, rows), (PipelineModel([binned, grouped]), rows))]
        assert errors[0] == pytest.approx(errors[1], rel=0.1)
    with pytest.raises(ValueError):
        tuning.tune(models.on_gathered(estimator), with_bins, choices, evaluator, weighted=weighted)


def test_a_gradient_reaches_the_driver_once(spark):
    frame = spark.range(0, 400, 1, 8).select(
        (F.col("id") % 2).cast("double").alias("target"),
        F.split(F.concat_ws(" ", F.col("id") % 7, F.col("id") % 3, F.lit("same")), " ").alias("filtered"),
    )
    stages = [prep.hash_terms(out="hashed"), prep.drop_constant()]
    rows = prep.build_pipeline(stages).fit(frame).transform(frame)
    # Seven words and three of the same names: what all texts have, or none has, is no feature.
    assert vector_size(rows, "features") == 7 and vector_size(rows, "hashed") == 1 << 18
    pieces, depth = models.summed_in_one(16)
    assert pieces >= 16 and models.summed_in_one(1)[0] == 1 and models.summed_in_one(113)[0] == 448
    spark.sparkContext.setJobGroup("one sum", "")
    models.logistic_regression("target", aggregationDepth=depth).fit(rows.repartition(pieces))
    tracker = spark.sparkContext.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("one sum")]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    ends = [tracker.getStageInfo(max(job.stageIds)).numTasks for job in jobs]
    # The eights read the rows and deal them.
    assert ends.count(1) > 5 and set(ends) <= {1, 8}
    whole = models.logistic_regression("target", "hashed").fit(rows)
    model = models.logistic_regression("target").fit(rows)
    assert sorted(round(c, 9) for c in model.coefficients if c) == sorted(round(c, 9) for c in whole.coefficients if c)


def vector_size(df, column):
    return len(df.select(vector_to_array(column).alias("v")).first()["v"])


def watched_tuning(monkeypatch):
    """Combinations and folds that a job tunes, by estimator; of each it fits the first only."""
    asked = {}

    def watched(estimator, train, param_grid, evaluator, folds=3, **options):
        asked[type(estimator).__name__] = (folds, [{p.name: v for p, v in chosen.items()} for chosen in param_grid])
        small = dict(param_grid[0]) | {p: 2 for p in param_grid[0] if p.name in ("maxIter", "maxDepth", "numTrees")}
        return estimator.fit(train, small), None

    monkeypatch.setattr(tuning, "tune", watched)
    return asked


def written_lines(spark, folder, n=400):
    """Order lines made here, as the table `lineitem` of a folder."""
    key = F.col("id")
    spark.range(n).select(
        (key * 31 + 1).alias("l_orderkey"), (key * 17 % 900).alias("l_partkey"), (key * 7 % 100).alias("l_suppkey"),
        (key % 6 + 2).cast("int").alias("l_linenumber"), (key % 50 + 1.0).alias("l_quantity"), (key * 13 % 900 + 100.0).alias("l_extendedprice"),
        (key % 11 / 100).alias("l_discount"), (key % 9 / 100).alias("l_tax"), F.when(key % 3 == 0, "O").otherwise("F").alias("l_linestatus"),
        F.lit("2024-03-01 00:00:00").cast("timestamp_ntz").alias("l_shipdate"),
    ).write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


def every(**values):
    return [dict(zip(values, chosen)) for chosen in product(*values.values())]


def in_order(choices):
    return sorted(choices, key=lambda chosen: sorted(chosen.items()))


def test_trip_models_go_through_their_whole_grids(spark, tmp_path, monkeypatch):
    asked = watched_tuning(monkeypatch)
    done = learning.r10_models(spark, written_lines(spark, tmp_path))
    assert {r["model"] for r in done.collect()} == {"linear", "generalized", "boosted", "forest"}
    folds, forests = asked["RandomForestRegressor"]
    assert folds == 3 and in_order(forests) == in_order(every(maxDepth=[5, 10, 15], numTrees=[50, 80]))
    assert in_order(asked["GBTRegressor"][1]) == every(maxIter=[15, 20, 25])
    assert in_order(asked["GeneralizedLinearRegression"][1]) == in_order(every(maxIter=[15, 20, 25], regParam=[0.6, 0.9]))


def test_text_models_go_through_their_whole_grids(spark, tmp_path, monkeypatch):
    asked = watched_tuning(monkeypatch)
    number = F.col("id")
    text = F.concat_ws(" ", F.lit("some good text with"), F.element_at(F.array(*map(F.lit, ["apples", "pears", "plums"])), (number % 3 + 1).cast("int")))
    spark.range(200).select(number.alias("doc_id"), text.alias("text")).write.parquet(f"{tmp_path}/documents.parquet")
    spark.range(200).select(number.alias("doc_id"), (number % 2).cast("int").alias("quality")).write.parquet(f"{tmp_path}/labels.parquet")
    assert {r["model"] for r in learning.r12(spark, str(tmp_path)).collect()} == {"logistic", "forest"}
    folds, forests = asked["RandomForestClassifier"]
    assert folds == 5 and in_order(forests) == in_order(every(maxDepth=[2, 4, 5], numTrees=[20, 30, 40]))
    folds, logistic = asked["LogisticRegression"]
    assert folds == 3 and in_order(logistic) == in_order(every(maxIter=[30, 40, 50], threshold=[0.8, 0.85]))


def test_fits_of_all_folds_run_side_by_side(spark):
    running, most, lock = [0], [0], threading.Lock()

    class Slow(Marking):
        def _fit(self, dataset):
            with lock:
                running[0] += 1
                most[0] = max(most[0], running[0])
            time.sleep(1.5)
            with lock:
                running[0] -= 1
            return self.inner.fit(dataset)

    inner = models.linear_regression("y")
    evaluator = RegressionEvaluator(labelCol="y")
    frame = folded_line(spark)
    _, report = tuning.tune(Slow(inner), frame, [{}], evaluator, folds=3, fold_column="fold")
    own = [evaluator.evaluate(inner.fit(frame.where(f"fold <> {k}")).transform(frame.where(f"fold = {k}"))) for k in range(3)]
    assert most[0] == 3 and report.first()["metric"] == pytest.approx(sum(own) / 3)


def test_forests_that_keep_nodes_are_the_same(spark):
    draw = random.Random(8)
    rows = [(Vectors.dense([draw.random(), draw.random(), float(draw.randrange(5))]), draw.random() * 9) for _ in range(600)]
    frame = spark.createDataFrame(rows, ["scaled", "y"]).repartition(3).cache()
    kept, walked = (models.forest_regressor("y", numTrees=6, maxDepth=12, **more).fit(frame) for more in ({}, {"cacheNodeIds": False}))
    assert kept.toDebugString.split("\n")[1:] == walked.toDebugString.split("\n")[1:] and kept.totalNumNodes > 1000
    frame.unpersist()


def test_fires_are_parsed_and_split_once(spark, tmp_path, monkeypatch):
    """The written rows are those of `hash_split` and `with_folds`, and the text is read by one pass."""
    written = []
    monkeypatch.setattr(learning, "cut_lineage", lambda df, real=cut_lineage: written.append(real(df)) or written[-1])
    asked = watched_tuning(monkeypatch)
    learning.r13_fires(spark, written_lines(spark, tmp_path))
    typed, train, test = written
    assert asked["RandomForestRegressor"][0] == 3 and {"_training", "fold"} <= set(typed.columns)
    columns = [c for c in typed.columns if c not in ("_training", "fold")]
    first, second = O.hash_split(typed, columns)
    assert first.where("NOT _training").isEmpty() and second.where("_training").isEmpty()
    assert (train.count(), test.count()) == (first.count(), second.count()) and test.count() > 0
    assert typed.where(F.col("fold") != tuning.fold_of(*columns, folds=3, seed=7)).isEmpty()
    assert not any("csv" in part for df in (train, test) for part in df.inputFiles())
