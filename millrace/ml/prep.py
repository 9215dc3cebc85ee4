"""Feature preparation stages and feature tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import (
    PCA,
    CountVectorizer,
    CountVectorizerModel,
    HashingTF,
    MinMaxScaler,
    RegexTokenizer,
    StopWordsRemover,
    StringIndexer,
    VarianceThresholdSelector,
    VectorAssembler,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.order import numbered
from millrace.session import cut_lineage


def index_strings(column: str, out: str) -> StringIndexer:
    """Frequent values first, ties by name; unseen values get an index of their own.

    The distinct values travel to the driver, so use it for categories. For a column with an
    unbounded number of values use `JoinIndexer`.
    """
    return StringIndexer(
        inputCol=column, outputCol=out, handleInvalid="keep", stringOrderType="frequencyDesc"
    )


def index_table(df: DataFrame, column: str, out: str = "index") -> DataFrame:
    """`column, n, out`: the same numbering as `index_strings`, as a table computed on executors."""
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    ranked = numbered(counted.withColumn("_order", -F.col("n")), ["_order", column], out)
    return ranked.select(column, "n", F.col(out).cast("double").alias(out))


class JoinIndexer(Estimator):
    """Index of a column with any number of values: the numbering of `index_strings`, kept as a table and joined.

    Values and their numbers never leave the executors. Unseen and missing values get the number after
    the last, as with `handleInvalid="keep"`.
    """

    def __init__(self, column: str, out: str):
        super().__init__()
        self.column, self.out = column, out

    def _fit(self, dataset: DataFrame) -> JoinIndexerModel:
        numbers = cut_lineage(index_table(dataset, self.column, self.out).select(self.column, self.out))
        return JoinIndexerModel(self.column, self.out, numbers, numbers.count())


class JoinIndexerModel(Transformer):
    """The fitted numbering. `numbers` is a written table, so a very frequent value may be split by AQE."""

    def __init__(self, column: str, out: str, numbers: DataFrame, size: int):
        super().__init__()
        self.column, self.out, self.numbers, self.size = column, out, numbers, size

    def _transform(self, dataset: DataFrame) -> DataFrame:
        known = self.numbers.select(F.col(self.column).alias("_value"), F.col(self.out).alias("_number"))
        joined = dataset.drop(self.out).join(known, F.col(self.column) == F.col("_value"), "left")
        number = F.coalesce("_number", F.lit(float(self.size)))
        return joined.withColumn(self.out, number).drop("_value", "_number")


class BinIndexer(Estimator):
    """Each feature of a vector as the number of its bin, at most `bins` of them, as the tree learners bin features.

    Few values get a bin each; more are cut at quantiles of all rows. Two passes, and at most some hundred numbers
    a feature reach the driver.
    """

    def __init__(self, column: str, out: str, bins: int = 32):
        super().__init__()
        self.column, self.out, self.bins = column, out, bins

    def _fit(self, dataset: DataFrame) -> BinIndexerModel:
        rows = dataset.select(vector_to_array(self.column).alias("_values"))
        first = rows.first()
        if first is None:
            raise ValueError("no rows to bin")
        places = range(len(first["_values"]))
        wanted = [k / self.bins for k in range(1, self.bins)]
        found = rows.agg(
            *[F.approx_count_distinct(F.col("_values")[i]).alias(f"n_{i}") for i in places],
            *[F.percentile_approx(F.col("_values")[i], wanted, 10_000).alias(f"q_{i}") for i in places],
        ).first()
        # The estimate is off by some per cent; the values of a feature that may have few are looked at.
        few = [i for i in places if found[f"n_{i}"] <= 2 * self.bins]
        sets = rows.agg(*[F.sort_array(F.collect_set(F.col("_values")[i])).alias(f"s_{i}") for i in few]).first() if few else {}
        cuts = []
        for i in places:
            values = sets[f"s_{i}"] if i in few else None
            if values is not None and len(values) <= self.bins:
                cuts.append([(low + high) / 2 for low, high in zip(values, values[1:])])
            else:
                cuts.append(sorted(set(found[f"q_{i}"])))
        return BinIndexerModel(self.column, self.out, cuts)


class BinIndexerModel(Transformer):
    """The fitted cuts of each feature: a value's bin is the number of cuts below it. What is no finite number stays."""

    def __init__(self, column: str, out: str, cuts: Sequence[Sequence[float]]):
        super().__init__()
        self.column, self.out, self.cuts = column, out, cuts

    def _transform(self, dataset: DataFrame) -> DataFrame:
        values = vector_to_array(self.column)

        def number(i: int) -> Column:
            below = sum(((values[i] > cut).cast("double") for cut in self.cuts[i]), F.lit(0.0))
            return F.when(F.isnan(values[i]) | (F.abs(values[i]) == float("inf")), values[i]).otherwise(below)

        return dataset.withColumn(self.out, array_to_vector(F.array(*[number(i) for i in range(len(self.cuts))])))


def assemble(columns: Sequence[str], out: str = "features", invalid: str = "error") -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol=out, handleInvalid=invalid)


def scale(column: str = "features", out: str = "scaled") -> MinMaxScaler:
    """Each feature to [0, 1]."""
    return MinMaxScaler(inputCol=column, outputCol=out, min=0.0, max=1.0)


def reduce(k: int = 3, column: str = "scaled", out: str = "reduced") -> PCA:
    return PCA(k=k, inputCol=column, outputCol=out)


def tokenize(column: str = "text", out: str = "words") -> RegexTokenizer:
    """Lower-cased words between non-word characters; letters with accents separate words too."""
    return RegexTokenizer(inputCol=column, outputCol=out, pattern="\\W")


def remove_stop_words(column: str = "words", out: str = "filtered") -> StopWordsRemover:
    return StopWordsRemover(inputCol=column, outputCol=out, locale="en_US")


def hash_terms(column: str = "filtered", out: str = "features", size: int = 1 << 18) -> HashingTF:
    return HashingTF(inputCol=column, outputCol=out, numFeatures=size)


def drop_constant(column: str = "hashed", out: str = "features") -> VarianceThresholdSelector:
    """Features with more than one value in the rows of the fit. A linear model gives the others no weight."""
    return VarianceThresholdSelector(featuresCol=column, outputCol=out, varianceThreshold=0.0)


def count_terms(
    column: str = "filtered", out: str = "features", size: int = 10_000, min_docs: float = 5.0
) -> CountVectorizer:
    return CountVectorizer(inputCol=column, outputCol=out, vocabSize=size, minDF=min_docs)


def frequent_terms(
    df: DataFrame, id_column: str, column: str = "filtered", size: int = 10_000, min_docs: int = 5
) -> list[str]:
    """The terms `count_terms` keeps, with ties at the limit decided by name; at most `size` of them."""
    return [
        row["term"]
        for row in df.select(id_column, F.explode(column).alias("term"))
        .groupBy(id_column, "term")
        .agg(F.count("*").alias("uses"))
        .groupBy("term")
        .agg(F.sum("uses").alias("uses"), F.count("*").alias("docs"))
        .where(F.col("docs") >= min_docs)
        .orderBy(F.desc("uses"), "term")
        .limit(size)
        .collect()
    ]


def count_known_terms(
    terms: Sequence[str], column: str = "filtered", out: str = "features"
) -> CountVectorizerModel:
    """Counts of the given terms, without a fit."""
    return CountVectorizerModel.from_vocabulary(list(terms), inputCol=column, outputCol=out)


def sparse_entries(column: str) -> tuple[Column, Column]:
    """Places and values of a sparse vector as two arrays, without filling in its zeros."""
    parts = F.unwrap_udt(column)
    return parts["indices"], parts["values"]


def strip_digits(df: DataFrame, column: str = "text") -> DataFrame:
    return df.withColumn(column, F.regexp_replace(column, "\\d+", ""))


def build_pipeline(prep: Sequence[Estimator | Transformer], estimator: Estimator | None = None) -> Pipeline:
    return Pipeline(stages=[*prep, *([estimator] if estimator is not None else [])])


def fit_predict(pipeline: Pipeline, train: DataFrame, test: DataFrame) -> tuple[PipelineModel, DataFrame]:
    model = pipeline.fit(train)
    return model, model.transform(test)
