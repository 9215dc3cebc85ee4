"""The corpus pipeline: five stages over `documents`, each written before the next reads it.

Toxic documents go; repeated runs of lines are deleted; of each group of near-duplicates the one
with the smallest id stays; documents that hold a benchmark item go; what is left is encoded to
SentencePiece ids and decoded again. All stages but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm.common import as_bytes, cut
from millrace.llm.decontamination import remove_contaminated
from millrace.llm.lines import fresh, remove_repeated_lines
from millrace.llm.pieces import round_trip
from millrace.llm.similar import similar_groups
from millrace.llm.toxicity import fit, score


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score under 0.5, unchanged."""
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(score(spark, as_bytes("text"), model) < 0.5)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, later copies of repeated line runs (maximal ones) deleted; `n_chars` follows the text."""
    done = remove_repeated_lines(docs)
    if "n_chars" not in docs.columns:
        return done
    length = F.length("text").cast(dict(docs.dtypes)["n_chars"])
    return done.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(length))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id.

    Documents are linked if their sets of five-word shingles have a similarity (Jaccard) of 0.8 at
    least; SimHash only finds the pairs to compare. The contract of op4 does not bind this stage. Texts without words are copies of each other, as in the operator; among them are the later copies
    whose lines all went before. Rows without an id stay, as do further rows of an id that stays.
    """
    marks = similar_groups(docs.where(F.col("doc_id").isNotNull()))
    key = fresh(docs, "_copy_of")
    copies = cut(
        marks.groupBy("doc_id").agg(F.min("component_id").alias("_root")).where("doc_id != _root"), "copies"
    ).select(F.col("doc_id").alias(key))
    return docs.join(copies, docs["doc_id"] == copies[key], "left_anti")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no template of a benchmark item, unchanged."""
    return remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """`doc_id, ids, decoded`: SentencePiece ids of the whole text, and the text they decode to."""
    return docs.select("doc_id", round_trip(spark, F.col("text")).alias("_both")).select("doc_id", "_both.*")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("sentencepiece", to_pieces),
]

# SQL can express neither the trained classifier nor the transducer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to `documents`; the result of each but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
