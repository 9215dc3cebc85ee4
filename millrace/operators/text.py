"""Word counts and inverted indexes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.order import numbered
from millrace.session import cut_lineage

# Fixed value: the characters a whitespace tokenizer splits at.
TOKEN = "[^ \\t\\n\\r\\f]+"


def words(column: str | Column, tokenizer: str = "space", lower: bool = False) -> Column:
    """Array of the words of a text.

    "space" splits at every single space and keeps empty words; "whitespace" takes runs of
    non-blank characters; any other value is the regular expression to split at.
    """
    text = F.col(column) if isinstance(column, str) else column
    if lower:
        text = F.lower(text)
    if tokenizer == "space":
        return F.split(text, " ")
    if tokenizer == "whitespace":
        return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))
    return F.split(text, tokenizer)


def word_count(
    df: DataFrame, column: str = "value", tokenizer: str = "space", lower: bool = False
) -> DataFrame:
    """`word, n`. Counts are combined before the shuffle, so a frequent word costs one row per task."""
    return (
        df.select(F.explode(words(column, tokenizer, lower)).alias("word"))
        .groupBy("word")
        .agg(F.count("word").alias("n"))
    )


def inverted_index(
    df: DataFrame,
    column: str = "value",
    file_column: str = "file",
    form: str = "pairs",
    tokenizer: str = "space",
    lower: bool = False,
    files_per_row: int = 50_000,
) -> DataFrame:
    """Where each word occurs.

    "pairs": `word, file, n`. "set": `word, block, n, files` (total and sorted files).
    "postings": `word, block, n, postings` with `file:n;file:n`, sorted by file.

    The last two list a word's files in rows of `files_per_row` at most, so that no task has to hold
    an unbounded list: block 0 has the first files of that word in order, block 1 the next ones. A word
    in few files has block 0 alone. `n` is the word's total in every block. Words are counted first. Those in
    `files_per_row` files at most, as nearly all, are one group each; for the others, places come from a
    running total over ranges of (word, file), so that no task has all files of one word.
    """
    pairs = (
        df.select(F.explode(words(column, tokenizer, lower)).alias("word"), F.col(file_column).alias("file"))
        .groupBy("word", "file")
        .agg(F.count("*").alias("n"))
    )
    if form == "pairs":
        return pairs
    if form == "set":
        row = F.sort_array(F.collect_list("file")).alias("files")
    elif form == "postings":
        entries = F.transform(
            F.sort_array(F.collect_list(F.struct("file", "n"))),
            lambda entry: F.concat(entry["file"], F.lit(":"), entry["n"].cast("string")),
        )
        row = F.array_join(entries, ";").alias("postings")
    else:
        raise ValueError(f"unknown form {form!r}")
    out = ["word", "block", "n", "postings" if form == "postings" else "files"]
    pairs = cut_lineage(pairs)
    totals = pairs.groupBy("word").agg(F.sum("n").alias("_total"), F.count("*").alias("_files"))
    large = cut_lineage(totals.where(F.col("_files") > files_per_row).select("word", "_total"))
    if large.isEmpty():
        return pairs.groupBy("word").agg(F.lit(0).alias("block"), F.sum("n").alias("n"), row).select(*out)
    few = pairs.join(large, "word", "left_anti").groupBy("word").agg(F.lit(0).alias("block"), F.sum("n").alias("n"), row)
    many = numbered(pairs.join(large, "word", "left_semi"), ["word", "file"], "_place")
    # A large word's first place, and so its blocks, from one row per word.
    firsts = cut_lineage(many.groupBy("word").agg(F.min("_place").alias("_first"))).join(large, "word")
    blocks = many.join(firsts, "word").withColumn(
        "block", F.coalesce(F.floor((F.col("_place") - F.col("_first")) / F.lit(files_per_row)).cast("int"), F.lit(0))
    )
    listed = blocks.groupBy("word", "block", "_total").agg(row).withColumnRenamed("_total", "n")
    return few.select(*out).unionByName(listed.select(*out))
