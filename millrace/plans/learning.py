"""Queries for feature preparation, models, tuning and evaluation, and the learning jobs."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    MulticlassClassificationEvaluator,
    RegressionEvaluator,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace.ml import metrics, models, normal, prep, tuning
from millrace.operators import tables as O
from millrace.plans import equations as E, views as V
from millrace.plans.catalog import query
from millrace.plans.jobs import measured_trips
from millrace.plans.tables import TRIP_BOX
from millrace.session import cut_lineage, new_folder, spread
from millrace.sources import files

table = V.table

# The English words that carry no meaning of their own.
STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers "
    "herself it its itself they them their theirs themselves what which who whom this that these those am is are "
    "was were be been being have has had having do does did doing a an the and but if or because as until while "
    "of at by for with about against between into through during before after above below to from up down in out "
    "on off over under again further then once here there when where why how all any both each few more most "
    "other some such no nor not only own same so than too very s t can will just don should now i'll you'll he'll "
    "she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've "
    "you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't "
    "shouldn't mustn't can't couldn't cannot could here's how's let's ought that's there's what's when's where's "
    "who's why's would"
).split()


def rounded(df, digits=6):
    """All double columns rounded."""
    return df.withColumns({c: F.round(c, digits) for c, kind in df.dtypes if kind == "double"})


def significant(df, digits=8):
    """All double columns to so many significant digits, as measures of any size can be compared."""
    text = f"%.{digits - 1}e"
    return df.withColumns(
        {c: F.when(F.col(c).isNotNull(), F.format_string(text, c)).cast("double").alias(c) for c, kind in df.dtypes if kind == "double"}
    )


# --- preparation ------------------------------------------------------------------------------


@query(
    "m01_string_index",
    """SELECT o_orderpriority AS value, CAST(row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1 AS DOUBLE)
              AS index, count(*) AS n FROM orders GROUP BY 1""",
)
def m01(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("value"))
    indexed = prep.index_strings("value", "index").fit(orders).transform(orders)
    return indexed.groupBy("value", "index").agg(F.count("*").alias("n"))


@query(
    "m01_string_index_table",
    """SELECT p_name, count(*) AS n, CAST(row_number() OVER (ORDER BY count(*) DESC, p_name) - 1 AS DOUBLE) AS index
       FROM part JOIN lineitem ON p_partkey = l_partkey GROUP BY 1""",
)
def m01_table(spark, sf_dir):
    part, lineitem = table(spark, sf_dir, "part"), table(spark, sf_dir, "lineitem")
    return prep.index_table(lineitem.join(part, lineitem.l_partkey == part.p_partkey), "p_name")


NUMBERS = ["l_quantity", "l_discount", "l_tax"]


@query(
    "m02_assemble",
    "SELECT l_orderkey, l_partkey, l_suppkey, l_quantity AS f0, l_discount AS f1, l_tax AS f2 FROM lineitem",
)
def m02(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", *NUMBERS)
    values = vector_to_array("features")
    return prep.assemble(NUMBERS).transform(lines).select(
        "l_orderkey", "l_partkey", "l_suppkey", *[values[n].alias(f"f{n}") for n in range(3)]
    )


@query(
    "m03_min_max_scale",
    "WITH b AS (SELECT "
    + ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in NUMBERS)
    + " FROM lineitem) SELECT l_orderkey, l_partkey, l_suppkey, "
    + ", ".join(f"round(({c} - lo_{c}) / (hi_{c} - lo_{c}), 9) AS f{n}" for n, c in enumerate(NUMBERS))
    + " FROM lineitem, b",
)
def m03(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", *NUMBERS)
    fitted = prep.build_pipeline([prep.assemble(NUMBERS), prep.scale()]).fit(lines)
    values = vector_to_array("scaled")
    return fitted.transform(lines).select(
        "l_orderkey", "l_partkey", "l_suppkey", *[F.round(values[n], 9).alias(f"f{n}") for n in range(3)]
    )


def payment_features(spark, sf_dir):
    payments = V.card_payments(table(spark, sf_dir, "embeddings"))
    return payments, [prep.assemble(O.columns_with_prefix(payments, "V")), prep.scale()]


@query(
    "m04_principal_components",
    """WITH v AS (SELECT unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
       s AS (SELECT i, var_samp(x) / pow(max(x) - min(x), 2) AS v FROM v GROUP BY i)
       SELECT (SELECT count(*) FROM embeddings) AS n, round(sum(v), 6) AS variance, true AS falling, true AS uncorrelated FROM s""",
)
def m04(spark, sf_dir):
    # As many components as measures keep all variance; each holds no more than the one before and nothing of it.
    payments, stages = payment_features(spark, sf_dir)
    whole = prep.build_pipeline([*stages, prep.reduce(V.MEASURES)]).fit(payments).transform(payments)
    parts = [vector_to_array("reduced")[n] for n in range(V.MEASURES)]
    kept = whole.select(*[part.alias(f"pc{n}") for n, part in enumerate(parts)])
    spreads = [F.var_samp(f"pc{n}") for n in range(V.MEASURES)]
    return kept.agg(
        F.count("*").alias("n"),
        F.round(sum(spreads[1:], spreads[0]), 6).alias("variance"),
        ((spreads[0] >= spreads[1]) & (spreads[1] >= spreads[2])).alias("falling"),
        (F.greatest(*[F.abs(F.corr(f"pc{a}", f"pc{b}")) for a, b in ((0, 1), (0, 2), (1, 2))]) < 1e-6).alias("uncorrelated"),
    )


TOKENS_SQL = """tokens AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '\\W'), lambda x: x <> '')
                AS words FROM documents)"""
STOP_SQL = ", ".join("'" + word.replace("'", "''") + "'" for word in STOP_WORDS)
FILTERED_SQL = f"""{TOKENS_SQL}, filtered AS (
  SELECT doc_id, list_filter(words, lambda x: NOT list_contains([{STOP_SQL}], x)) AS words FROM tokens)"""
DIGEST_SQL = "doc_id, CAST(len(words) AS INTEGER) AS n, md5(array_to_string(words, ' ')) AS digest"


def word_digest(df, column):
    joined = F.array_join(column, " ").cast("binary")
    return df.select("doc_id", F.size(column).alias("n"), F.md5(joined).alias("digest"))


@query("m05_regex_tokens", f"WITH {TOKENS_SQL} SELECT {DIGEST_SQL} FROM tokens")
def m05(spark, sf_dir):
    documents = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return word_digest(prep.tokenize().transform(documents), "words")


def filtered_words(spark, sf_dir):
    documents = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return prep.remove_stop_words().transform(prep.tokenize().transform(documents)).select("doc_id", "filtered")


@query("m06_stop_words", f"WITH {FILTERED_SQL} SELECT {DIGEST_SQL} FROM filtered")
def m06(spark, sf_dir):
    return word_digest(filtered_words(spark, sf_dir), "filtered")


@query(
    "m07_hashed_term_counts",
    f"WITH {FILTERED_SQL} SELECT doc_id, CAST(len(words) AS DOUBLE) AS terms FROM filtered",
)
def m07(spark, sf_dir):
    # Words may share a bucket, but no occurrence may get lost.
    _, counts = prep.sparse_entries("features")
    total = F.aggregate(counts, F.lit(0.0), lambda a, b: a + b)
    return prep.hash_terms().transform(filtered_words(spark, sf_dir)).select("doc_id", total.alias("terms"))


@query(
    "m08_vocabulary",
    f"""WITH {FILTERED_SQL}, t AS (SELECT doc_id, unnest(words) AS term FROM filtered),
        c AS (SELECT term, count(*) AS uses, count(DISTINCT doc_id) AS docs FROM t GROUP BY 1)
        SELECT term, docs, uses FROM c WHERE docs >= 5 ORDER BY uses DESC, term LIMIT 10000""",
)
def m08(spark, sf_dir):
    words = cut_lineage(filtered_words(spark, sf_dir))
    vocabulary = prep.frequent_terms(words, "doc_id")
    fitted = prep.count_known_terms(vocabulary)
    # The vocabulary has at most 10,000 entries by definition.
    terms = spark.createDataFrame(list(enumerate(vocabulary)), "place INT, term STRING")
    places, counts = prep.sparse_entries("features")
    entries = fitted.transform(words).select(F.inline(F.arrays_zip(places.alias("place"), counts.alias("uses"))))
    per_place = entries.toDF("place", "uses").groupBy("place").agg(
        F.count("*").alias("docs"), F.sum("uses").cast("bigint").alias("uses")
    )
    return per_place.join(F.broadcast(terms), "place").select("term", "docs", "uses")


# --- models -----------------------------------------------------------------------------------


def price_rows(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_quantity", "l_discount", "l_tax", F.col("l_extendedprice").alias("price")
    )


@query(
    "m09_linear_regression",
    """SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
              round(regr_intercept(l_extendedprice, l_quantity), 3) AS intercept FROM lineitem""",
)
def m09(spark, sf_dir):
    rows = prep.assemble(["l_quantity"]).transform(price_rows(spark, sf_dir))
    fitted = models.linear_regression("price", "features").fit(rows)
    line = [(float(fitted.coefficients[0]), float(fitted.intercept))]
    return spark.createDataFrame(line, "slope DOUBLE, intercept DOUBLE").select(
        F.round("slope", 4).alias("slope"), F.round("intercept", 3).alias("intercept")
    )


SPLIT_SQL = "substr(md5(l_orderkey || '|42'), 1, 8) <= 'cccccccc'"


@query(
    "m10_linear_report",
    f"""WITH train AS (SELECT l_quantity AS x, l_extendedprice AS y FROM lineitem WHERE {SPLIT_SQL}),
        test AS (SELECT l_quantity AS x, l_extendedprice AS y FROM lineitem WHERE NOT {SPLIT_SQL}),
        line AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM train),
        errors AS (SELECT 'train' AS part, y, y - a - b * x AS e FROM train, line
                   UNION ALL SELECT 'test', y, y - a - b * x FROM test, line),
        quality AS (SELECT part, sqrt(avg(e * e)) AS rmse, 1 - sum(e * e) / (var_pop(y) * count(*)) AS r2
                    FROM errors GROUP BY 1)
        SELECT 'model' AS part, 'coefficient_0' AS name, round(b, 3) AS value FROM line
        UNION ALL SELECT 'model', 'intercept', round(a, 3) FROM line
        UNION ALL SELECT part, 'rmse', round(rmse, 3) FROM quality
        UNION ALL SELECT part, 'r2', round(r2, 3) FROM quality""",
)
def m10(spark, sf_dir):
    rows = prep.assemble(["l_quantity"]).transform(price_rows(spark, sf_dir))
    train, test = O.hash_split(rows, ["l_orderkey"])
    return models.linear_report(models.linear_regression("price", "features").fit(train), test, digits=3)


def split_prices(spark, sf_dir):
    """Prepared training and test rows, written once: every fit and every pass re-reads them."""
    train, test = O.hash_split(price_rows(spark, sf_dir), ["l_orderkey"])
    fitted = prep.build_pipeline([prep.assemble(NUMBERS), prep.scale()]).fit(train)
    return tuple(cut_lineage(fitted.transform(part).select("l_orderkey", "scaled", "price")) for part in (train, test))


def evaluated(estimator, train, test, label):
    return significant(metrics.regression_metrics(estimator.fit(train).transform(test), label))


SCALED_SQL = f"""bounds AS (SELECT {', '.join(f'min({c}) AS lo_{c}, max({c}) AS hi_{c}' for c in NUMBERS)} FROM lineitem WHERE {SPLIT_SQL}),
scaled AS (SELECT l_orderkey, l_extendedprice AS price, {SPLIT_SQL} AS training,
  {', '.join(f'({c} - lo_{c}) / (hi_{c} - lo_{c}) AS f{n}' for n, c in enumerate(NUMBERS))} FROM lineitem, bounds),
train AS (SELECT * FROM scaled WHERE training)"""
SCALED = [f"f{n}" for n in range(len(NUMBERS))]


@query(
    "m11_generalized_linear",
    f"""WITH {SCALED_SQL}, {E.solved('w', 'train', SCALED, 'price', 0.3)},
        tested AS (SELECT price, {E.predicted(SCALED)} AS p FROM scaled, w WHERE NOT training)
        {E.metrics('price', 'p', 'tested')}""",
)
def m11(spark, sf_dir):
    return evaluated(models.generalized_linear("price"), *split_prices(spark, sf_dir), "price")


@query(
    "m11_normal_equations",
    f"""WITH {SCALED_SQL}, {E.solved('w', 'train', SCALED, 'price', 0.3)}
        SELECT unnest(['f0', 'f1', 'f2', 'intercept']) AS name, unnest([round(w0, 4), round(w1, 4), round(w2, 4), round(c, 4)]) AS value,
               true AS agrees FROM w""",
)
def m11_normal(spark, sf_dir):
    # The library's solver and the sums of products over the same rows agree on every weight.
    train, _ = split_prices(spark, sf_dir)
    fitted = models.generalized_linear("price").fit(train)
    values = vector_to_array("scaled")
    flat = train.select("price", *[values[n].alias(f"f{n}") for n in range(len(NUMBERS))])
    own = normal.model_table(flat, normal.fit_linear(flat, SCALED, "price", 0.3))
    theirs = spark.createDataFrame(
        [*zip(SCALED, map(float, fitted.coefficients)), ("intercept", float(fitted.intercept))], "name STRING, theirs DOUBLE"
    )
    same = F.abs(F.col("value") - F.col("theirs")) <= 1e-8 * F.greatest(F.abs("value"), F.lit(1.0))
    return own.join(theirs, "name").select("name", F.round("value", 4).alias("value"), same.alias("agrees"))


def sound(model, train, test, label):
    """One row `n, finite, fits`: every test row has a prediction, and the training rows are on average nearer to
    theirs than to the mean label. (These labels are drawn at random: nothing in them carries over to new rows.)"""
    predicted = model.transform(test)
    usable = F.col("prediction").isNotNull() & ~F.isnan("prediction") & (F.abs("prediction") < float("inf"))
    error = F.avg((F.col("prediction") - F.col(label)) ** 2)
    fits = model.transform(train).agg((error < F.var_pop(label) * (1 + 1e-9)).alias("fits"))
    return predicted.agg(F.count("*").alias("n"), F.bool_and(usable).alias("finite")).crossJoin(fits)  # one row each


SOUND_SQL = f"SELECT count(*) AS n, true AS finite, true AS fits FROM lineitem WHERE NOT {SPLIT_SQL}"


@query("m12_boosted_trees", SOUND_SQL)
def m12(spark, sf_dir):
    train, test = split_prices(spark, sf_dir)
    return sound(models.fit_boosted(models.boosted_trees("price"), train), train, test, "price")


@query("m13_forest_regressor", SOUND_SQL)
def m13(spark, sf_dir):
    train, test = split_prices(spark, sf_dir)
    return sound(models.forest_regressor("price").fit(train), train, test, "price")


def sound_classes(model, train, test, label, score):
    """One row `n, classes, separates`: every test row has a known class, and the score puts the training rows of the
    two classes in the right order more often than not."""
    kept = cut_lineage(model.transform(train).select(F.col(label).cast("double").alias("y"), vector_to_array(score)[1].alias("score")))
    return model.transform(test).agg(
        F.count("*").alias("n"),
        F.bool_and(F.col("prediction").isin(0.0, 1.0)).alias("classes"),
        F.first(metrics.auc(kept, "y", "score").scalar() > 0.5).alias("separates"),
    )


def split_payments(spark, sf_dir):
    """All payments in training and test part with scaled features, written once."""
    payments, stages = payment_features(spark, sf_dir)
    train, test = O.hash_split(payments, ["id"])
    fitted = prep.build_pipeline(stages).fit(train)
    return tuple(cut_lineage(fitted.transform(part).select("id", "scaled", "fraud")) for part in (train, test))


PAYMENT_SPLIT_SQL = "substr(md5(vec_id || '|42'), 1, 8) <= 'cccccccc'"
SOUND_CLASSES_SQL = f"""SELECT count(*) AS n, true AS classes, true AS separates
  FROM embeddings WHERE NOT {PAYMENT_SPLIT_SQL}"""


@query("m14_logistic_regression", SOUND_CLASSES_SQL)
def m14(spark, sf_dir):
    train, test = split_payments(spark, sf_dir)
    return sound_classes(models.logistic_regression("fraud", "scaled", threshold=0.3).fit(train), train, test, "fraud", "probability")


@query("m15_forest_classifier", SOUND_CLASSES_SQL)
def m15(spark, sf_dir):
    train, test = split_payments(spark, sf_dir)
    return sound_classes(models.forest_classifier("fraud", "scaled").fit(train), train, test, "fraud", "probability")


@query("m16_linear_svm", SOUND_CLASSES_SQL)
def m16(spark, sf_dir):
    train, test = split_payments(spark, sf_dir)
    return sound_classes(models.linear_svm("fraud").fit(train), train, test, "fraud", "rawPrediction")


LINE_SQL = f"""line AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b,
  regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem WHERE {SPLIT_SQL})"""


def line_predictions(spark, sf_dir):
    """Prices of the test rows from a pipeline fitted to the training rows, on the scaled quantity."""
    train, test = O.hash_split(price_rows(spark, sf_dir), ["l_orderkey"])
    stages = [prep.assemble(["l_quantity"]), prep.scale()]
    _, predicted = prep.fit_predict(
        prep.build_pipeline(stages, models.linear_regression("price")), train, test
    )
    return predicted


@query(
    "m17_fit_transform",
    f"""WITH {LINE_SQL} SELECT l_orderkey, l_extendedprice AS price, round(a + b * l_quantity, 3) AS prediction
        FROM lineitem, line WHERE NOT {SPLIT_SQL}""",
)
def m17(spark, sf_dir):
    predicted = line_predictions(spark, sf_dir)
    return predicted.select("l_orderkey", "price", F.round("prediction", 3).alias("prediction"))


FOLDS = 3
# The hexadecimal digits of a hash below k / 3 of their range: the folds of `tuning.fold_of`.
FOLD_SQL = "CAST(floor(CAST('0x' || substr(md5(l_orderkey || '|7'), 1, 8) AS BIGINT) / 4294967296.0e0 * 3) AS INTEGER)"


def fold_errors_sql(penalties, folds):
    """Table expressions ending in `errors(fold, penalty, rmse)`: ridge models of all other folds, tried on each."""
    parts = [f"{SCALED_SQL}, folded AS (SELECT *, {FOLD_SQL} AS fold FROM train)",
             f"others AS (SELECT folded.*, k FROM folded, (VALUES {', '.join(f'({k})' for k in folds)}) v(k) WHERE fold <> k)"]
    for n, penalty in enumerate(penalties):
        parts.append(E.solved(f"w{n}_", "others", SCALED, "price", penalty, keys="k"))
        parts.append(
            f"e{n} AS (SELECT k, {penalty} AS penalty, sqrt(avg(pow(price - ({E.predicted(SCALED)}), 2))) AS rmse "
            f"FROM folded JOIN w{n}_ ON fold = k GROUP BY k)"
        )
    return ",\n".join(parts) + ",\nerrors AS (" + " UNION ALL ".join(f"SELECT * FROM e{n}" for n in range(len(penalties))) + ")"


def folded_prices(spark, sf_dir):
    """Training rows with their folds, written: a hash in a filter would be made again by each pass of each fit."""
    train, _ = split_prices(spark, sf_dir)
    return cut_lineage(with_folds(train, "l_orderkey").select("scaled", "price", "fold"))


@query(
    "m19_cross_validation",
    f"""WITH {fold_errors_sql([0.0, 0.3], range(3))},
        means AS (SELECT penalty, avg(rmse) AS metric FROM errors GROUP BY 1)
        SELECT 'maxIter=' || i || ', regParam=' || penalty AS params, round(metric, 4) AS metric FROM means, (VALUES (10), (20)) v(i)""",
)
def m19(spark, sf_dir):
    estimator = models.linear_regression("price")
    choices = tuning.grid({estimator.regParam: [0.0, 0.3], estimator.maxIter: [10, 20]})
    evaluator = RegressionEvaluator(labelCol="price")
    _, report = tuning.tune(estimator, folded_prices(spark, sf_dir), choices, evaluator, folds=FOLDS, fold_column="fold")
    return report.select("params", F.round("metric", 4).alias("metric"))


@query(
    "m20_validation_split",
    f"""WITH {fold_errors_sql([0.6, 0.9], [0])}
        SELECT 'maxIter=' || i || ', regParam=' || penalty AS params, round(rmse, 4) AS metric
        FROM errors, (VALUES (15), (20), (25)) v(i)""",
)
def m20(spark, sf_dir):
    estimator = models.generalized_linear("price")
    choices = tuning.grid({estimator.maxIter: [15, 20, 25], estimator.regParam: [0.6, 0.9]})
    evaluator = RegressionEvaluator(labelCol="price")
    _, report = tuning.tune(estimator, folded_prices(spark, sf_dir), choices, evaluator, folds=None, fold_column="fold")
    return report.select("params", F.round("metric", 4).alias("metric"))


@query(
    "m21_best_parameters",
    f"""WITH {fold_errors_sql([50.0, 0.0, 0.3, 5000.0], range(3))}
        SELECT 'regParam=' || penalty AS params, round(avg(rmse), 4) AS metric FROM errors GROUP BY penalty ORDER BY avg(rmse) LIMIT 1""",
)
def m21(spark, sf_dir):
    estimator = models.linear_regression("price")
    choices = tuning.grid({estimator.regParam: [50.0, 0.0, 0.3, 5000.0]})
    evaluator = RegressionEvaluator(labelCol="price")
    _, report = tuning.tune(estimator, folded_prices(spark, sf_dir), choices, evaluator, folds=FOLDS, fold_column="fold")
    return report.where("best").select("params", F.round("metric", 4).alias("metric"))


# --- samples ----------------------------------------------------------------------------------


@query(
    "m22_hash_split",
    """SELECT o_orderkey, CASE WHEN substr(md5(o_orderkey || '|42'), 1, 8) <= 'cccccccc' THEN 'train' ELSE 'test' END
              AS part FROM orders""",
)
def m22(spark, sf_dir):
    train, test = O.hash_split(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"])
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query("m22_random_split", "SELECT count(*) AS n, true AS apart, true AS usual FROM orders")
def m22_random(spark, sf_dir):
    # Every row is in just one part, and the parts are about as large as asked for.
    train, test = cut_lineage(table(spark, sf_dir, "orders").select("o_orderkey")).randomSplit([0.8, 0.2], 42)
    both = train.withColumn("in_train", F.lit(1)).unionByName(test.withColumn("in_train", F.lit(0)))
    share = F.avg("in_train")
    margin = 5 * 0.4 / F.sqrt(F.count("*"))  # five deviations
    return both.agg(
        F.count("*").alias("n"),
        (F.count("*") == F.count_distinct("o_orderkey")).alias("apart"),
        (F.abs(share - 0.8) < margin).alias("usual"),
    )


@query(
    "m23_balanced_sample",
    """SELECT doc_id, toxic FROM labels WHERE toxic = 1
       UNION ALL (SELECT doc_id, toxic FROM labels WHERE toxic = 0 ORDER BY md5(doc_id || '|42'), doc_id
                  LIMIT (SELECT count(*) FROM labels WHERE toxic = 1))""",
)
def m23(spark, sf_dir):
    return O.balance(table(spark, sf_dir, "labels").select("doc_id", "toxic"), "toxic", "doc_id")


# --- evaluation -------------------------------------------------------------------------------

GUESS_SQL = "(SELECT l_extendedprice AS y, l_quantity * 1500 AS p FROM lineitem)"


def guesses(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 1500).alias("prediction")
    )


@query(
    "m24_regression_metrics",
    f"""SELECT round(avg((y - p) * (y - p)), 2) AS mse, round(sqrt(avg((y - p) * (y - p))), 4) AS rmse,
               round(avg(abs(y - p)), 4) AS mae,
               round(1 - avg((y - p) * (y - p)) / var_pop(y), 6) AS r2 FROM {GUESS_SQL}""",
)
def m24(spark, sf_dir):
    measured = metrics.regression_metrics(guesses(spark, sf_dir), "y")
    digits = {"mse": 2, "rmse": 4, "mae": 4, "r2": 6}
    return measured.select(*[F.round(name, d).alias(name) for name, d in digits.items()])


@query(
    "m25_log_errors",
    f"""SELECT round(sqrt(avg(pow(ln(1 + p) - ln(1 + y), 2))), 6) AS rmsle,
               round(ln(sqrt(avg((y - p) * (y - p)))), 6) AS log_rmse FROM {GUESS_SQL}""",
)
def m25(spark, sf_dir):
    return rounded(metrics.regression_metrics(guesses(spark, sf_dir), "y").select("rmsle", "log_rmse"))


SCORED_SQL = """scored AS (SELECT quality, CAST(n_chars AS DOUBLE) AS score,
  CASE WHEN n_chars > 1000 THEN 1.0e0 ELSE 0.0e0 END AS prediction FROM labels JOIN documents USING (doc_id))"""


def scored(spark, sf_dir):
    """Labelled documents with their length as a score and a guess made from it."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return table(spark, sf_dir, "labels").join(documents, "doc_id").select(
        "quality",
        F.col("n_chars").cast("double").alias("score"),
        F.when(F.col("n_chars") > 1000, 1.0).otherwise(0.0).alias("prediction"),
    )


@query(
    "a17_confusion",
    f"WITH {SCORED_SQL} SELECT quality AS label, prediction, count(*) AS n FROM scored GROUP BY 1, 2",
)
def a17(spark, sf_dir):
    return metrics.confusion(scored(spark, sf_dir), "quality")


@query(
    "m26_area_under_roc",
    f"""WITH {SCORED_SQL}, r AS (SELECT quality, rank() OVER (ORDER BY score)
            + (count(*) OVER (PARTITION BY score) - 1) / 2.0e0 AS r FROM scored)
        SELECT round((sum(r) FILTER (quality = 1) - p * (p + 1) / 2.0e0) / (p * n), 9) AS auc
        FROM r, (SELECT count(*) FILTER (quality = 1) AS p, count(*) FILTER (quality <> 1) AS n FROM scored)
        GROUP BY p, n""",
)
def m26(spark, sf_dir):
    return rounded(metrics.auc(scored(spark, sf_dir), "quality", "score"), 9)


@query(
    "m27_weighted_metrics",
    f"""WITH {SCORED_SQL}, c AS (SELECT CAST(quality AS DOUBLE) AS cls, count(*) AS actual,
            count(*) FILTER (quality = prediction) AS hit FROM scored GROUP BY 1),
        g AS (SELECT prediction AS cls, count(*) AS predicted FROM scored GROUP BY 1)
        SELECT round(sum(actual * coalesce(hit / predicted, 0)) / sum(actual), 9) AS "precision",
               round(sum(hit) / sum(actual), 9) AS recall, round(sum(hit) / sum(actual), 9) AS accuracy
        FROM c LEFT JOIN g USING (cls)""",
)
def m27(spark, sf_dir):
    return rounded(metrics.classification_metrics(scored(spark, sf_dir), "quality"), 9)


CORRELATED = ["l_quantity", "l_extendedprice", "l_discount", "l_linenumber"]


@query(
    "m28_pearson",
    " UNION ALL ".join(
        f"SELECT '{a}' AS i, '{b}' AS j, round("
        + ("CAST(1 AS DOUBLE)" if a == b else f"corr({a}, {b})")
        + ", 6) AS corr FROM lineitem"
        + (" GROUP BY 1, 2" if a == b else "")
        for a in CORRELATED
        for b in CORRELATED
    ),
)
def m28(spark, sf_dir):
    return rounded(metrics.correlation(table(spark, sf_dir, "lineitem").select(*CORRELATED), CORRELATED))


RANKS_SQL = ", ".join(
    f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0e0 AS {c}" for c in CORRELATED
)


@query(
    "m29_spearman",
    f"WITH r AS (SELECT {RANKS_SQL} FROM lineitem) "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS i, '{b}' AS j, round("
        + ("CAST(1 AS DOUBLE)" if a == b else f"corr({a}, {b})")
        + ", 6) AS corr FROM r"
        + (" GROUP BY 1, 2" if a == b else "")
        for a in CORRELATED
        for b in CORRELATED
    ),
)
def m29(spark, sf_dir):
    rows = spread(table(spark, sf_dir, "lineitem").select(*CORRELATED))
    return rounded(metrics.correlation(rows, CORRELATED, "spearman"))


@query(
    "m30_write_predictions",
    f"""WITH {LINE_SQL} SELECT l_orderkey AS id, round(a + b * l_quantity, 3) AS prediction
        FROM lineitem, line WHERE NOT {SPLIT_SQL}""",
)
def m30(spark, sf_dir):
    path = new_folder(spark, "predictions")
    files.write_csv(line_predictions(spark, sf_dir).select("l_orderkey", "prediction"), path)
    written = files.read_csv(spark, path, "id BIGINT, prediction DOUBLE", header=False)
    return written.select("id", F.round("prediction", 3).alias("prediction"))


# --- jobs -------------------------------------------------------------------------------------

CLEAN_SQL = f"""{V.TRIPS_SQL},
boxed AS (SELECT * FROM distances WHERE pickup_longitude BETWEEN -74.25 AND -73.7
  AND dropoff_longitude BETWEEN -74.25 AND -73.7 AND pickup_latitude BETWEEN 40.6 AND 40.9
  AND dropoff_latitude BETWEEN 40.6 AND 40.9),
near AS (SELECT * FROM boxed, (SELECT avg(distance) AS m, stddev_samp(distance) AS s FROM boxed)
         WHERE distance BETWEEN m - s AND m + s AND passenger_count > 0),
clean AS (SELECT * FROM near, (SELECT avg(trip_duration) AS m2, stddev_samp(trip_duration) AS s2 FROM near)
          WHERE trip_duration BETWEEN m2 - s2 AND m2 + s2)"""


def clean_trips(trips):
    """Complete trips within the area, of usual length and duration, with passengers.

    The trips within the area are passed over three times, so they are written once with their distances.
    """
    trips = cut_lineage(O.within(O.drop_missing(trips), TRIP_BOX))
    trips = O.drop_outliers(trips, "distance").where(F.col("passenger_count") > 0)
    return O.drop_outliers(trips, "trip_duration")


@query("r10_clean_trips", f"WITH {CLEAN_SQL} SELECT id, round(distance, 6) AS distance, trip_duration FROM clean")
def r10_clean(spark, sf_dir):
    trips = clean_trips(measured_trips(spark, sf_dir))
    return trips.select("id", F.round("distance", 6).alias("distance"), "trip_duration")


TRIP_FEATURES = ["vendor_id", "passenger_count", "hour", "day", "flag_ind", "distance"]


def prepared_trips(spark, sf_dir):
    """Features of the cleaned trips, in training and test part, written once for all models."""
    label = "trip_duration"
    clean = cut_lineage(clean_trips(measured_trips(spark, sf_dir)))
    train, test = O.hash_split(clean, ["id"])
    stages = [prep.index_strings("store_and_fwd_flag", "flag_ind"), prep.assemble(TRIP_FEATURES), prep.scale()]
    fitted = prep.build_pipeline(stages).fit(train)
    return [cut_lineage(fitted.transform(part).select("id", "scaled", label)) for part in (train, test)]


def all_reports(reports):
    """Reports of several models below each other."""
    named = [report.select(F.lit(name).alias("model"), "*") for name, report in reports.items()]
    return reduce(lambda a, b: a.unionByName(b), named)


def each_model(names, sql):
    """SQL of a report with the same row for each model."""
    return f"SELECT model, r.* FROM (VALUES {', '.join(f'({n!r})' for n in names)}) v(model), ({sql}) r"


def with_folds(train, *ids, folds=FOLDS):
    """Training rows with the folds of a tuning, fixed by a hash of their identity."""
    return train.withColumn("fold", tuning.fold_of(*ids, folds=folds, seed=7))


TRIP_SPLIT_SQL = "substr(md5(id || '|42'), 1, 8) <= 'cccccccc'"
# The grids of the trip models. Here and below, `r11` goes through a part of the forest's grid (see README).
TRIP_GRIDS = {
    "generalized": {"maxIter": [15, 20, 25], "regParam": [0.6, 0.9]},
    "boosted": {"maxIter": [15, 20, 25]},
    "forest": {"maxDepth": [5, 10, 15], "numTrees": [50, 80]},
}


def chosen_grid(estimator, values):
    return tuning.grid({getattr(estimator, name): choices for name, choices in values.items()})


@query(
    "r10_trip_models",
    f"WITH {CLEAN_SQL} "
    + each_model(
        ["linear", *TRIP_GRIDS], f"SELECT count(*) AS n, true AS finite, true AS fits FROM clean WHERE NOT {TRIP_SPLIT_SQL}"
    ),
)
def r10_models(spark, sf_dir, grids=TRIP_GRIDS):
    label = "trip_duration"
    train, test = prepared_trips(spark, sf_dir)
    folded = cut_lineage(with_folds(train, "id"))
    evaluator = RegressionEvaluator(labelCol=label, metricName="rmse")
    tuned = {
        "generalized": (models.generalized_linear(label), None),
        "boosted": (models.boosted_trees(label), None),
        "forest": (models.forest_regressor(label), FOLDS),
    }
    fitted = {"linear": models.linear_regression(label).fit(train)}
    gathered = models.gather(folded, "scaled", label, ["id"], "fold")
    for name, (estimator, folds) in tuned.items():
        grid = chosen_grid(estimator, grids[name])
        if gathered and name in ("boosted", "forest"):
            binned, rows, weighted = gathered
            best, _ = tuning.tune(
                models.on_gathered(estimator), rows, grid, evaluator, folds=folds, fold_column="fold", weighted=weighted
            )
            fitted[name] = PipelineModel([binned, best])
        else:
            fitted[name], _ = tuning.tune(estimator, folded, grid, evaluator, folds=folds, fold_column="fold")
    return all_reports({name: sound(model, train, test, label) for name, model in fitted.items()})


BANDED_SQL = """CASE WHEN e <= 50 THEN '0-50' WHEN e <= 200 THEN '50-200' WHEN e <= 500 THEN '200-500'
  WHEN e <= 5000 THEN '500-5000' ELSE '5000+' END"""


@query(
    "r10_error_bands",
    f"""WITH {CLEAN_SQL}, ready AS (SELECT *, CASE store_and_fwd_flag WHEN 'N' THEN 0 ELSE 1 END AS flag_ind FROM clean),
        train AS (SELECT * FROM ready WHERE {TRIP_SPLIT_SQL}), {E.solved('w', 'train', TRIP_FEATURES, 'trip_duration')},
        errors AS (SELECT abs(trip_duration - ({E.predicted(TRIP_FEATURES)})) AS e FROM ready, w WHERE NOT {TRIP_SPLIT_SQL})
        SELECT {BANDED_SQL} AS range, count(*) AS n FROM errors GROUP BY 1""",
)
def r10_bands(spark, sf_dir):
    train, test = prepared_trips(spark, sf_dir)
    predicted = models.linear_regression("trip_duration").fit(train).transform(test)
    return O.error_bands(predicted, "trip_duration")


# The grids of the fraud models.
FRAUD_GRIDS = {
    "logistic": {"k": [3, 6, 9], "threshold": [0.5, 0.75]},
    "svm": {"k": [3, 6, 9]},
    "forest": {"k": [3, 6, 9], "maxDepth": [3, 7, 9], "numTrees": [40, 60, 80]},
}


def balanced_sql(source, rare, id_column):
    """Ids of a balanced sample: all rows of the rarer class and as many others, by hash."""
    return f"""(SELECT {id_column} FROM {source} WHERE {rare} UNION ALL
      (SELECT {id_column} FROM {source} WHERE NOT ({rare}) ORDER BY md5({id_column} || '|42'), {id_column}
       LIMIT (SELECT count(*) FROM {source} WHERE {rare})))"""


@query(
    "r11_fraud_models",
    each_model(
        FRAUD_GRIDS,
        f"""SELECT count(*) AS n, true AS classes, true AS separates
            FROM {balanced_sql('embeddings', 'label = 0', 'vec_id')} WHERE NOT {PAYMENT_SPLIT_SQL}""",
    ),
)
def r11(spark, sf_dir, grids=FRAUD_GRIDS | {"forest": {"k": [3, 6, 9], "maxDepth": [3], "numTrees": [40]}}):
    payments, stages = payment_features(spark, sf_dir)
    train, test = O.hash_split(cut_lineage(O.balance(payments, "fraud", "id")), ["id"])
    scaled = prep.build_pipeline(stages).fit(train)
    train, test = (cut_lineage(scaled.transform(part).select("id", "scaled", "fraud")) for part in (train, test))
    folded = cut_lineage(with_folds(train, "id"))
    f1 = MulticlassClassificationEvaluator(labelCol="fraud", metricName="f1")
    roc = BinaryClassificationEvaluator(labelCol="fraud")
    kinds = {
        "logistic": (models.logistic_regression("fraud", "reduced"), f1, "probability"),
        "svm": (models.linear_svm("fraud", "reduced"), roc, "rawPrediction"),
        "forest": (models.forest_classifier("fraud", "reduced"), roc, "probability"),
    }
    reports = {}
    for name, (estimator, evaluator, score) in kinds.items():
        # The number of components is tuned together with the model, hence a pipeline of both.
        reduced = prep.reduce(3)
        choices = {getattr(reduced if key == "k" else estimator, key): values for key, values in grids[name].items()}
        whole = prep.build_pipeline([reduced], estimator)
        # One fit at a time: the decomposition inside PCA fails now and then when several run in one process.
        best, _ = tuning.tune(
            whole, folded, tuning.grid(choices), evaluator, folds=FOLDS, fold_column="fold", parallelism=1
        )
        reports[name] = sound_classes(best, train, test, "fraud", score)
    return all_reports(reports)


# The grids and folds of the text models.
TEXT_GRIDS = {
    "logistic": {"maxIter": [30, 40, 50], "threshold": [0.8, 0.85]},
    "forest": {"maxDepth": [2, 4, 5], "numTrees": [20, 30, 40]},
}
TEXT_FOLDS = {"logistic": 3, "forest": 5}


@query(
    "r12_text_models",
    "WITH m AS (SELECT doc_id AS id, quality FROM labels JOIN documents USING (doc_id) WHERE text IS NOT NULL AND quality IS NOT NULL) "
    + each_model(
        TEXT_GRIDS,
        f"""SELECT count(*) AS n, true AS classes, true AS separates
            FROM {balanced_sql('m', 'quality = 0', 'id')} WHERE NOT {TRIP_SPLIT_SQL}""",
    ),
)
def r12(spark, sf_dir, grids=TEXT_GRIDS, folds=TEXT_FOLDS):
    raw = V.messages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    words = prep.remove_stop_words().transform(prep.tokenize().transform(prep.strip_digits(O.drop_missing(raw))))
    kept = cut_lineage(words.select("id", "filtered", "target"))
    # The rarer class is kept whole and the other one sampled down to its size. The sample is drawn
    # from ids alone; the words are read once more for the chosen ones.
    chosen = O.balance(kept.select("id", "target"), "target", "id", kept=0, sampled=1)
    balanced = cut_lineage(kept.join(chosen.select("id"), "id", "left_semi"))
    train, test = O.hash_split(balanced, ["id"])
    roc = BinaryClassificationEvaluator(labelCol="target")
    f1 = MulticlassClassificationEvaluator(labelCol="target", metricName="f1")
    kinds = {
        "logistic": ([prep.hash_terms(out="hashed"), prep.drop_constant()], models.logistic_regression("target"), f1),
        "forest": ([prep.count_terms()], models.forest_classifier("target"), roc),
    }
    reports = {}
    for name, (stages, estimator, evaluator) in kinds.items():
        fitted = prep.build_pipeline(stages).fit(train)
        if name == "logistic" and not fitted.stages[-1].selectedFeatures:
            fitted = prep.build_pipeline([prep.hash_terms()]).fit(train)
        # Without the names of some hundred thousand features, which no model needs.
        features = F.col("features").alias("features", metadata={})
        parts = [cut_lineage(fitted.transform(part).select("id", features, "target")) for part in (train, test)]
        folded = cut_lineage(with_folds(parts[0], "id", folds=folds[name]).select("features", "target", "fold"))
        grid = chosen_grid(estimator, grids[name])
        pieces = None
        if name == "logistic":
            # A gradient has a number per hashed term: it is added up on executors, and one sum goes to the driver.
            pieces, depth = models.summed_in_one(folded.rdd.getNumPartitions())
            estimator.setAggregationDepth(depth)
        best, _ = tuning.tune(estimator, folded, grid, evaluator, folds=folds[name], fold_column="fold", pieces=pieces)
        reports[name] = sound_classes(best, *parts, "target", "probability")
    return all_reports(reports)


# The grid of the fire model, and the part of it that the query goes through: trees of 30 levels may
# have a leaf for each row (see README).
FIRE_GRID_WHOLE = {"maxDepth": [5, 10, 15, 20, 25, 30], "numTrees": [20, 40, 60, 80, 100, 120]}
FIRE_GRID = {"maxDepth": [5, 10], "numTrees": [20]}


@query(
    "r13_fire_models",
    each_model(
        ["linear", "forest"],
        "SELECT count(*) AS n, true AS finite, true AS fits FROM lineitem WHERE l_partkey % 50 <> 0",
    ),
)
def r13_fires(spark, sf_dir, grid=FIRE_GRID):
    path = new_folder(spark, "csv")
    files.write_csv(V.fire_strings(table(spark, sf_dir, "lineitem")), path, header=True)
    fires = files.cast_columns(files.read_csv_strings(spark, path, V.FIRE_COLUMNS), V.FIRE_TYPES)
    fires = O.drop_missing(fires.drop("X", "Y", "month", "day"))
    features = [c for c in fires.columns if c != "area"]
    # The text is parsed and its rows are hashed in one pass; what follows reads the written numbers.
    typed = cut_lineage(with_folds(fires, *fires.columns).withColumn("_training", O.in_share(fires.columns)))
    train, test = (typed.where(part) for part in (F.col("_training"), ~F.col("_training")))
    fitted = prep.build_pipeline([prep.assemble(features), prep.scale()]).fit(train)
    train, test = (
        cut_lineage(fitted.transform(part).select("scaled", "area", *extra)) for part, extra in ((train, ["fold"]), (test, []))
    )
    forest = models.forest_regressor("area")
    best, _ = tuning.tune(
        forest, train, chosen_grid(forest, grid), RegressionEvaluator(labelCol="area"), folds=FOLDS, fold_column="fold"
    )
    linear = models.linear_regression("area").fit(train)
    trained = train.agg(F.count("*").alias("_trained"))
    reports = {name: sound(model, train, test, "area") for name, model in (("linear", linear), ("forest", best))}
    # Rows of both parts: all complete ones are in one of them.
    return all_reports(
        {name: report.crossJoin(trained).withColumn("n", F.col("n") + F.col("_trained")).drop("_trained") for name, report in reports.items()}
    )


GAME_SPLIT_SQL = "substr(md5(game_id || '|42'), 1, 8) <= 'cccccccc'"


@query(
    "r13_rating_model",
    f"""WITH games AS (SELECT o_orderkey AS game_id, c_name AS nickname, CAST(trunc(o_totalprice / 1000) AS INTEGER) AS score,
                              CAST(trunc(c_acctbal / 10 + o_totalprice / 2000) AS INTEGER) AS rating
                       FROM orders JOIN customer ON o_custkey = c_custkey),
        numbers AS (SELECT nickname, row_number() OVER (ORDER BY count(*) DESC, nickname) - 1 AS number
                    FROM games WHERE {GAME_SPLIT_SQL} GROUP BY 1),
        ready AS (SELECT games.*, coalesce(number, (SELECT count(*) FROM numbers))::DOUBLE AS player FROM games LEFT JOIN numbers USING (nickname)),
        train AS (SELECT * FROM ready WHERE {GAME_SPLIT_SQL}), {E.solved('w', 'train', ['player', 'score'], 'rating')},
        tested AS (SELECT rating, {E.predicted(['player', 'score'])} AS p FROM ready, w WHERE NOT {GAME_SPLIT_SQL})
        {E.metrics('rating', 'p', 'tested')}""",
)
def r13_ratings(spark, sf_dir):
    rated = O.drop_missing(V.ratings(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")))
    train, test = O.hash_split(rated, ["game_id"])
    stages = [prep.JoinIndexer("nickname", "player"), prep.assemble(["player", "score"]), prep.scale()]
    _, predicted = prep.fit_predict(prep.build_pipeline(stages, models.linear_regression("rating")), train, test)
    return significant(metrics.regression_metrics(predicted, "rating"))


GAME_FEATURES = ["initial_time_seconds", "increment_seconds", "max_overtime_minutes", "winner_index"]


@query(
    "r13_duration_report",
    f"""WITH games AS (SELECT o_orderkey AS game_id, o_custkey % 20 * 60 AS initial_time_seconds, o_orderkey % 10 AS increment_seconds,
                              o_orderkey % 4 AS max_overtime_minutes, o_orderstatus AS winner,
                              o_totalprice / 500 + o_custkey % 20 * 30 AS seconds FROM orders),
        numbers AS (SELECT winner, (row_number() OVER (ORDER BY count(*) DESC, winner) - 1)::DOUBLE AS winner_index
                    FROM games WHERE {GAME_SPLIT_SQL} GROUP BY 1),
        ready AS (SELECT games.*, winner_index, CASE WHEN {GAME_SPLIT_SQL} THEN 'train' ELSE 'test' END AS part FROM games JOIN numbers USING (winner)),
        train AS (SELECT * FROM ready WHERE part = 'train'), {E.solved('w', 'train', GAME_FEATURES, 'seconds')},
        errors AS (SELECT part, seconds, seconds - ({E.predicted(GAME_FEATURES)}) AS e FROM ready, w),
        quality AS (SELECT part, sqrt(avg(e * e)) AS rmse, 1 - avg(e * e) / var_pop(seconds) AS r2 FROM errors GROUP BY 1)
        SELECT part, name, CAST(printf('%.7e', value) AS DOUBLE) AS value FROM (
          SELECT 'model' AS part, unnest(['coefficient_0', 'coefficient_1', 'coefficient_2', 'coefficient_3', 'intercept']) AS name,
                 unnest([w0, w1, w2, w3, c]) AS value FROM w
          UNION ALL SELECT part, unnest(['rmse', 'r2']), unnest([rmse, r2]) FROM quality)""",
)
def r13_durations(spark, sf_dir):
    played = V.games(table(spark, sf_dir, "orders"))
    train, test = O.hash_split(played, ["game_id"])
    # The duration is the label and therefore no feature.
    stages = [prep.index_strings("winner", "winner_index"), prep.assemble(GAME_FEATURES)]
    fitted = prep.build_pipeline(stages).fit(train)
    train, test = (fitted.transform(part).select("features", "game_duration_seconds") for part in (train, test))
    train = cut_lineage(train)
    model = models.linear_regression("game_duration_seconds", "features").fit(train)
    return significant(models.linear_report(model, test, digits=15))


@query(
    "r13_residuals",
    """WITH line AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a
                     FROM lineitem)
       SELECT l_orderkey, round(l_extendedprice - a - b * l_quantity, 2) AS residual FROM lineitem, line""",
)
def r13_residuals(spark, sf_dir):
    rows = prep.assemble(["l_quantity"]).transform(price_rows(spark, sf_dir))
    fitted = models.linear_regression("price", "features").fit(rows)
    return models.residuals(fitted.transform(rows), "price").select(
        "l_orderkey", F.round("residual", 2).alias("residual")
    )


