"""Labelled rows for the classifiers: a bounded, repeatable sample of whole texts, fetched as features."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.common import as_bytes, slices, trainable


def sample(
    docs: DataFrame,
    label: Column,
    rows: int,
    feature: Callable[[Column], Column],
    id_column: str = "doc_id",
    text_column: str = "text",
    marks: DataFrame | None = None,
    per_label: int | None = None,
) -> list[tuple]:
    """At most `rows` training rows (label, feature), those with the least hash of their id.

    `label` is a column of `docs`, or of `marks` (ids with labels) if that is given. With `per_label` each label
    has at most so many rows, so that a rare one is not crowded out. Held-out documents and null labels are
    left out. `feature` makes of a whole text (as bytes), inside a task, what the model learns from; only
    that is fetched, so the bound is one on rows and no text is cut.
    """
    ids = (docs if marks is None else marks).where(trainable(F.col(id_column)) & label.isNotNull()).select(
        F.col(id_column).cast("bigint").alias("_key"), label.alias("_label")
    )
    # Ids and labels are put in order first; texts are read for the few rows that are taken.
    order = [F.xxhash64("_key", F.lit(7)), F.col("_key"), F.col("_label")]
    ids = ids.distinct()
    if per_label is not None:
        # Spark keeps the first rows of each label before it shuffles.
        place = F.row_number().over(Window.partitionBy("_label").orderBy(*order[:2]))
        ids = ids.withColumn("_place", place).where(F.col("_place") <= per_label).drop("_place")
    taken = ids.orderBy(*order).limit(rows)
    texts = docs.select(F.col(id_column).cast("bigint").alias("_id"), as_bytes(text_column).alias("_text"))
    made = texts.join(F.broadcast(taken), F.col("_id") == F.col("_key")).select(
        "_label", feature(F.col("_text")).alias("_feature"), order[0].alias("_order")
    )
    return [(r["_label"], r["_feature"]) for r in made.orderBy("_order", "_label", "_feature").limit(rows).collect()]


def in_tasks(work: Callable, kind: pa.DataType, returned: str, limit: int) -> Callable[[Column], Column]:
    """A feature for `sample`: `work` on the bytes and bounds of a slice gives a list of values, one per text."""

    def run(values: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([values], names=["t"])
        found = [value for _, data, bounds in slices([batch], "t", limit) for value in work(data, bounds)]
        return pa.array(found, kind)

    run.__annotations__ = {"values": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, returned)


def labelled(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """`doc_id, _quality, _toxic` of the ids of `docs`; labels of several rows of an id are averaged, ties are null."""
    marks = labels.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        *[
            F.when(F.avg(c) > 0.5, 1).when(F.avg(c) < 0.5, 0).alias(f"_{c}")
            for c in ("quality", "toxic")
            if c in labels.columns
        ]
    )
    ids = docs.select(F.col(id_column).cast("bigint").alias("_known"))
    return marks.join(ids, F.col("doc_id") == F.col("_known"), "left_semi")
