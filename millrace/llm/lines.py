"""Removal of repeated runs of lines by prefix doubling over sequences of line ids.

The rank of a position at level k is a name of the 2^k lines that start there: at level 0 of the line, then of
the pair of ranks at the position and half way on. Spark groups equal names after every doubling, names that
occur once leave, and the ranks of all levels are kept. Positions with one name form an interval of the suffix array
whose common prefix has that length at least.

Any run of n lines has a name too, two ranks of the largest level that fits, one at its start and one at its end.
A repeated run with enough text is the union of the least windows with enough text that start at one of
its lines or end at one: a line before which the run holds enough is the end of such a window inside the run,
any other lies in the window from the run's start. So the intervals of these two windows of every line
give all maximal repeated runs: the first position of an interval (least id, then text, then line) stays, and the
lines that later ones cover, put together, are deleted. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from millrace.llm.common import cut

MIN_CHARS = 40
_PLACE = ["_id", "_th"]


def fresh(df: DataFrame, name: str) -> str:
    """`name`, with underscores added until no column of `df` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"{name}_"
    return name


def _place() -> Column:
    return F.struct("_id", "_th", "_pos")


def _ranked(rows: DataFrame) -> DataFrame:
    """Positions whose name occurs twice or more, with the first position of that name.

    The names are written before the join, so that the rows of one that is very frequent can be split.
    """
    names = cut(
        rows.groupBy("_name", "_check")
        .agg(F.count(F.lit(1)).alias("_n"), F.min(_place()).alias("_first"))
        .where("_n > 1")
        .select("_name", "_check", "_first"),
        "names",
    )
    return rows.join(names, ["_name", "_check"])


def _least_windows(lengths: Column, min_chars: int, first: Column, step: int) -> Column:
    """Lines from `first` on, in steps of 1 or -1, that hold `min_chars` just so; null if none do."""
    near = (
        F.slice(lengths, first + 1, F.lit(min_chars))
        if step > 0
        else F.reverse(F.slice(lengths, F.greatest(first + 2 - min_chars, F.lit(1)), F.least(first + 1, F.lit(min_chars))))
    )
    start = F.struct(F.lit(0).cast("bigint").alias("chars"), F.lit(0).alias("n"))
    found = F.aggregate(
        near,
        start,
        lambda s, x: F.when(s["chars"] >= min_chars, s).otherwise(
            F.struct((s["chars"] + x).alias("chars"), (s["n"] + 1).alias("n"))
        ),
    )
    # The array of one binds the sum to a name, so that it is made once.
    return F.get(F.transform(F.array(found), lambda s: F.when(s["chars"] >= min_chars, s["n"])), F.lit(0))


def _lines(docs: DataFrame, id_column: str, text_column: str, min_chars: int) -> DataFrame:
    """`_id, _th, _pos, _name, _check, _ahead, _back` of each line: its names, and how many lines from it on, and up
    to it, hold enough text just so (null if none do). Rows with equal id and text are one."""
    texts = docs.where(F.col(text_column).isNotNull()).select(
        F.col(id_column).cast("bigint").alias("_id"),
        F.xxhash64(text_column).alias("_th"),
        F.split(text_column, "\n").alias("_lines"),
    )
    texts = texts.withColumn("_sizes", F.transform("_lines", lambda x: (F.length(x) + 1).cast("bigint")))

    def line(text: Column, i: Column) -> Column:
        return F.struct(
            i.alias("_pos"),
            F.xxhash64(text).alias("_name"),
            F.hash(text, F.length(text)).alias("_check"),
            _least_windows(F.col("_sizes"), min_chars, i, 1).alias("_ahead"),
            _least_windows(F.col("_sizes"), min_chars, i, -1).alias("_back"),
        )

    return texts.select(*_PLACE, F.inline(F.transform("_lines", line))).distinct()


def _at(name: str, offset: Column) -> Column:
    """Whether a row of the left frame and `_id2, _th2, _pos2` are `offset` lines apart in one text."""
    return F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_th") == F.col("_th2")) & (F.col(name) + offset == F.col("_pos2"))


def _others(ranks: DataFrame) -> DataFrame:
    return ranks.select(
        F.col("_id").alias("_id2"), F.col("_th").alias("_th2"), F.col("_pos").alias("_pos2"),
        F.col("_name").alias("_name2"), F.col("_check").alias("_check2"),
    )


def _later_windows(docs: DataFrame, id_column: str, text_column: str, min_chars: int) -> DataFrame:
    """`_id, _th, _start, _end` of the later copies of all least windows with enough text."""
    least = max(1, min_chars)  # every line has a character, its newline
    lines = cut(_ranked(_lines(docs, id_column, text_column, least)), "ranks0")
    ranks = lines.select(*_PLACE, "_pos", "_name", "_check")
    spans = F.array(
        F.struct(F.col("_pos").alias("_start"), F.col("_ahead").alias("_many")),
        F.struct((F.col("_pos") - F.col("_back") + 1).alias("_start"), F.col("_back").alias("_many")),
    )
    # A line may be the only one of both its windows, and the end of another's.
    windows = cut(lines.select(*_PLACE, F.inline(spans)).where("_many IS NOT NULL").distinct(), "spans")
    named, level = None, 0
    while True:
        span = 1 << level
        mine = windows.where(F.col("_many").between(span, 2 * span - 1))
        starts = mine.join(_others(ranks), _at("_start", F.lit(0))).select(
            *_PLACE, "_start", "_many", F.col("_name2").alias("_name1"), F.col("_check2").alias("_check1")
        )
        both = starts.join(_others(ranks), _at("_start", F.col("_many") - span)).select(
            *_PLACE,
            F.col("_start").alias("_pos"),
            "_many",
            F.xxhash64("_name1", "_name2", "_many").alias("_name"),
            F.hash("_check1", "_check2", "_name2").alias("_check"),
        )
        named = both if named is None else named.unionByName(both)
        if 2 * span > least:  # a least window has a line for each character at most
            break
        doubled = ranks.join(_others(ranks), _at("_pos", F.lit(span))).select(
            *_PLACE,
            "_pos",
            F.xxhash64("_name", "_name2").alias("_name"),
            F.hash("_check", "_check2", "_name2").alias("_check"),
        )
        level += 1
        ranks = cut(_ranked(doubled).select(*_PLACE, "_pos", "_name", "_check"), f"ranks{level}")
    found = _ranked(cut(named, "windows"))
    return found.where(_place() > F.col("_first")).select(
        *_PLACE, F.col("_pos").alias("_start"), (F.col("_pos") + F.col("_many") - 1).alias("_end")
    )


def repeated_runs(docs: DataFrame, id_column: str, text_column: str, min_chars: int) -> DataFrame:
    """`_id, _th, _runs`: per text, its runs of lines to delete as sorted structs (start, end) from 0."""
    decided = _later_windows(docs, id_column, text_column, min_chars)
    order = W.partitionBy(*_PLACE).orderBy("_start", "_end")
    reach = F.max("_end").over(order.rowsBetween(W.unboundedPreceding, -1))
    islands = decided.withColumn("_new", F.when(F.col("_start") <= reach + 1, 0).otherwise(1)).withColumn(
        "_run", F.sum("_new").over(order.rowsBetween(W.unboundedPreceding, 0))
    )
    runs = islands.groupBy(*_PLACE, "_run").agg(F.min("_start").alias("start"), F.max("_end").alias("end"))
    return runs.groupBy(*_PLACE).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("_runs"))


def _kept(lines: Column, runs: Column) -> Column:
    """Lines outside of sorted runs: the stretches between neighbouring runs, joined."""
    n = F.size(lines)
    closed = F.concat(runs, F.array(F.struct(n.alias("start"), n.alias("end"))))

    def stretch(run: Column, i: Column) -> Column:
        before = F.when(i == 0, F.lit(-1)).otherwise(F.get(closed, i - 1)["end"])
        return F.slice(lines, before + 2, F.greatest(run["start"] - before - 1, F.lit(0)))

    return F.flatten(F.transform(closed, stretch))


def remove_repeated_lines(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_chars: int = MIN_CHARS,
    report: str | None = None,
) -> DataFrame:
    """The rows and columns of `docs` with repeated runs of lines deleted from the text.

    Lines end at newlines. All lines of every run of lines that holds `min_chars` characters, newlines counted,
    go if the same run stands at a smaller place (id, then hash of the text, then line), whatever its
    number of lines. The first copy always stays whole.
    `report` names an added struct `n_lines, n_removed, n_runs`.

    Null texts stay null; an empty text is one short line; a text whose lines all go becomes empty.
    Rows with equal id and text are one place, so that repeated rows do not delete each other; a
    null id comes before all others. Extra columns pass through whatever their names. An empty
    table gives an empty one. There are log2(min_chars) doublings.
    """
    runs = repeated_runs(docs.select(id_column, text_column), id_column, text_column, min_chars)
    key, digest, found = (fresh(docs, c) for c in ("_line_id", "_line_text", "_line_runs"))
    runs = runs.select(F.col("_id").alias(key), F.col("_th").alias(digest), F.col("_runs").alias(found))
    joined = docs.join(
        runs,
        docs[id_column].cast("bigint").eqNullSafe(runs[key]) & (F.xxhash64(docs[text_column]) == runs[digest]),
        "left",
    )
    lines = F.split(text_column, "\n")
    text = F.when(F.col(found).isNull(), F.col(text_column)).otherwise(F.array_join(_kept(lines, F.col(found)), "\n"))
    columns = [text.alias(c) if c == text_column else F.col(c) for c in docs.columns]
    if report:
        removed = F.aggregate(found, F.lit(0).cast("bigint"), lambda n, r: n + r["end"] - r["start"] + 1)
        columns.append(
            F.struct(
                F.when(F.col(text_column).isNull(), 0).otherwise(F.size(lines)).cast("bigint").alias("n_lines"),
                F.coalesce(removed, F.lit(0)).alias("n_removed"),
                F.when(F.col(found).isNull(), 0).otherwise(F.size(found)).cast("bigint").alias("n_runs"),
            ).alias(report)
        )
    return joined.select(*columns)
