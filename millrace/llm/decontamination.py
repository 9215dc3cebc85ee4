"""Benchmark decontamination by templates: numbers, names and units become typed placeholders.

A text turns into template tokens: lower-case words, and placeholders for numbers, for units after a
number, and for names (capitalised words inside a sentence). Windows of template tokens are
hash-joined with those of the benchmark, and the values in the slots of all windows on one
alignment must map one to one, so that a question asked again with other values is caught and a
chance likeness is not. DataFrame functions only.

Every window of 13 tokens holds one of 7 that starts at a multiple of 7; so texts are first joined
by those, a seventh of the rows, and only texts that meet a benchmark item go on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.common import cut
from millrace.llm.lines import fresh

WINDOW_TOKENS = 13
MIN_LITERALS = 7
BROADCAST_ROWS = 200_000

# Placeholders (private-use characters, which no token keeps), patterns, units.
NUMBER, NAME, UNIT = "", "", ""
# Repeated groups are possessive (`*+`): each step of a plain `*` takes stack in the JVM, and a long enough run of
# names or numbers ended the executor. Nothing follows them, so they match the same.
NUMBERS = r"[0-9]+(?:[.,:/][0-9]+)*+"
# A name follows a space after anything but the end of a sentence; neighbouring names are one.
NAMES = r"\s(?<![.!?:\s]\s)\s{0,2}(\p{Lu}[\p{L}\p{N}'’-]*(?:\s{1,3}\p{Lu}[\p{L}\p{N}'’-]*)*+)"
BREAKS = r"[\s\p{P}\p{S}]+"
UNITS = (
    "mm cm m km in inch inches ft feet yd yards mi miles mg g kg lb lbs oz grams kilograms pounds ml l liters litres "
    "gallons s sec seconds min minutes h hr hours days weeks months years percent dollars euros cents degrees mph kmh kph"
).split()


def marked(text: Column) -> Column:
    """Text with placeholders for names and numbers, values gone."""
    plain = F.translate(text, NUMBER + NAME + UNIT, "   ")
    named = F.regexp_replace(plain, NAMES, f" {NAME} ")
    return F.regexp_replace(named, NUMBERS, f" {NUMBER} ")


def tokens(text: Column) -> Column:
    """Template tokens of a text; no tokens for null or blank."""
    low = F.lower(marked(F.coalesce(text, F.lit(""))))
    units = F.regexp_replace(low, rf"{NUMBER}\s{{1,3}}(?:{'|'.join(UNITS)})(?![^\s\p{{P}}\p{{S}}])", f"{NUMBER} {UNIT}")
    return F.array_remove(F.split(units, BREAKS), "")


def slot_values(text: Column) -> tuple[Column, Column]:
    """Values of the name slots and of the number slots of a text, in order."""
    plain = F.translate(text, NUMBER + NAME + UNIT, "   ")
    named = F.regexp_replace(plain, NAMES, f" {NAME} ")
    return (
        F.regexp_extract_all(plain, F.lit(NAMES), F.lit(1)),
        F.regexp_extract_all(named, F.lit(NUMBERS), F.lit(0)),
    )


def _starts(words: Column, size: int, stride: int = 1) -> Column:
    return F.when(F.size(words) >= size, F.sequence(F.lit(1), F.size(words) - size + 1, F.lit(stride))).otherwise(
        F.array().cast("array<int>")
    )


def _hashes(words: Column, size: int, stride: int = 1) -> Column:
    # The array of one binds the tokens to a name, so that they are made once and not for each start.
    return F.flatten(
        F.transform(
            F.array(words), lambda w: F.transform(_starts(w, size, stride), lambda i: F.xxhash64(F.slice(w, i, size)))
        )
    )


def _small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast below a measured number of (fixed-size) rows; beyond it the join shuffles."""
    return F.broadcast(df) if df.count() <= rows else df


def _starting(rows: DataFrame, size: int, *keys: str) -> DataFrame:
    """One row per window: its hash and start (from 1)."""
    hashed = rows.select(*keys, F.posexplode(_hashes(F.col("_tokens"), size)).alias("_at", "_hash"))
    return hashed.select(*keys, "_hash", (F.col("_at") + 1).alias("_start"))


def _slots(size: int) -> dict[str, Column]:
    """Of a window at `_start`: the number of its words, and the values of its slots in order."""
    window = F.slice("_tokens", F.col("_start"), size)
    before = lambda kind: F.size(F.filter(F.slice("_tokens", 1, F.col("_start") - 1), lambda t: t == kind))
    inside = lambda kind: F.size(F.filter(window, lambda t: t == kind))
    return {
        "words": F.size(F.filter(window, lambda t: ~t.isin(NUMBER, NAME, UNIT))),
        "names": F.slice("_names", before(NAME) + 1, inside(NAME)),
        "numbers": F.slice("_numbers", before(NUMBER) + 1, inside(NUMBER)),
    }


def _pairs(kind: str) -> Column:
    return F.transform(
        F.arrays_zip(F.col(f"_item{kind}").alias("a"), F.col(f"_of{kind}").alias("b")),
        lambda z: F.struct(F.lower(z["a"]).alias("a"), F.lower(z["b"]).alias("b"), F.lit(kind).alias("kind")),
    )


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    size: int = WINDOW_TOKENS,
    min_literals: int = MIN_LITERALS,
) -> DataFrame:
    """`_id, _th, item_id, n_windows`: documents and the benchmark items whose template they hold.

    `_th` is the hash of the text, so that rows that share an id are told apart. `n_windows` counts
    the windows of `size` template tokens of the best alignment. An alignment counts only if no
    value of the item stands for two of the document or the other way round, or else only with its
    windows whose values all equal the item's; windows with fewer
    than `min_literals` words need equal values too, for few words are alike by chance.

    Null, empty and blank texts hold nothing; documents or items below `size` tokens match nothing.
    Items with equal text are reported each; repeated rows of a document are one. Null ids are ids
    like any other. An empty benchmark or table gives an empty result.
    """
    rows = docs.where(F.col(text_column).isNotNull()).select(
        F.col(id_column).cast("bigint").alias("_id"), F.xxhash64(text_column).alias("_th"), F.col(text_column).alias("_text")
    )
    questions = benchmark.where("text IS NOT NULL").select(
        F.col("item_id").cast("bigint").alias("item_id"), F.col("text").alias("_text")
    ).distinct()
    items = cut(
        questions.select(
            "item_id",
            tokens(F.col("_text")).alias("_tokens"),
            slot_values(F.col("_text"))[0].alias("_names"),
            slot_values(F.col("_text"))[1].alias("_numbers"),
        ),
        "items",
    )
    inner = (size + 1) // 2
    keys = items.select(F.explode(_hashes(F.col("_tokens"), inner)).alias("_hash")).distinct()
    meeting = cut(
        rows.select("_id", "_th", F.explode(_hashes(tokens(F.col("_text")), inner, size - inner + 1)).alias("_hash"))
        .join(_small(keys, BROADCAST_ROWS), "_hash", "left_semi")
        .select("_id", "_th")
        .distinct(),
        "meeting",
    ).select(F.col("_id").alias("_id2"), F.col("_th").alias("_th2"))
    some = rows.join(
        meeting, F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_th") == F.col("_th2")), "left_semi"
    ).dropDuplicates(["_id", "_th"])
    some = some.select(
        "_id",
        "_th",
        tokens(F.col("_text")).alias("_tokens"),
        slot_values(F.col("_text"))[0].alias("_names"),
        slot_values(F.col("_text"))[1].alias("_numbers"),
    )
    some = cut(some, "some")
    of_item = _slots(size)
    asked = cut(
        _starting(items, size, "item_id").join(items, "item_id").select(
            "item_id",
            "_hash",
            F.col("_start").alias("_item_start"),
            of_item["words"].alias("_words"),
            of_item["names"].alias("_item_names"),
            of_item["numbers"].alias("_item_numbers"),
        ),
        "asked",
    )
    # Slots are looked up only for windows that meet an item.
    hits = cut(_starting(some, size, "_id", "_th").join(_small(asked, BROADCAST_ROWS), "_hash"), "hits")
    named = some.select(F.col("_id").alias("_id2"), F.col("_th").alias("_th2"), "_tokens", "_names", "_numbers")
    of_doc = _slots(size)
    hits = hits.join(named, F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_th") == F.col("_th2"))).select(
        *hits.columns, of_doc["names"].alias("_of_names"), of_doc["numbers"].alias("_of_numbers")
    )
    values = F.concat(_pairs("_names"), _pairs("_numbers"))
    hits = hits.withColumn("_values", values).where(
        (F.col("_words") >= min_literals) | F.forall("_values", lambda z: z["a"].eqNullSafe(z["b"]))
    )
    key = ["_id", "_th", "item_id", "_shift"]
    hits = hits.select("_id", "_th", "item_id", (F.col("_start") - F.col("_item_start")).alias("_shift"), "_values").withColumn(
        "_equal", F.forall("_values", lambda z: z["a"].eqNullSafe(z["b"]))
    )
    slots = (
        hits.select(*key, F.explode("_values").alias("_z"))
        .groupBy(*key)
        .agg(
            F.countDistinct("_z").alias("_both"),
            F.countDistinct("_z.kind", "_z.a").alias("_left"),
            F.countDistinct("_z.kind", "_z.b").alias("_right"),
        )
        .where("_both != _left OR _both != _right")
        .select(F.col("_id").alias("_id2"), F.col("_th").alias("_th2"), F.col("item_id").alias("_item2"), F.col("_shift").alias("_shift2"), F.lit(True).alias("_clash"))
    )
    counted = hits.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), F.count_if("_equal").alias("_same"))
    # Where values clash, the windows that were copied with equal values count all the same.
    consistent = counted.join(
        slots,
        F.col("_id").eqNullSafe(F.col("_id2"))
        & (F.col("_th") == F.col("_th2"))
        & F.col("item_id").eqNullSafe(F.col("_item2"))
        & (F.col("_shift") == F.col("_shift2")),
        "left",
    ).withColumn("_n", F.when(F.col("_clash"), F.col("_same")).otherwise(F.col("_n"))).where("_n > 0")
    return consistent.groupBy("_id", "_th", "item_id").agg(F.max("_n").alias("n_windows"))


def remove_contaminated(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options
) -> DataFrame:
    """Rows of `docs`, all columns, that hold no template of a benchmark item (see `contaminated`)."""
    found = cut(contaminated(docs, benchmark, id_column, text_column, **options), "contaminated")
    key, digest = fresh(docs, "_leak_id"), fresh(docs, "_leak_text")
    gone = found.select(F.col("_id").alias(key), F.col("_th").alias(digest)).distinct()
    match = docs[id_column].cast("bigint").eqNullSafe(gone[key]) & (F.xxhash64(docs[text_column]) == gone[digest])
    return docs.join(gone, match, "left_anti")
