"""The registered queries of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


OP8_SQL = """
WITH h AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS t FROM documents),
w AS (SELECT doc_id, t, unnest(generate_series(1, CAST(length(t) // 2 - 399 AS BIGINT))) AS p FROM h WHERE length(t) >= 800),
k AS (SELECT doc_id, p, md5_number(substr(t, 2 * p - 1, 800)) AS m FROM w),
d AS (SELECT doc_id, p FROM k QUALIFY count(*) OVER (PARTITION BY m) > 1),
g AS (SELECT doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 400 THEN 0 ELSE 1 END AS fresh FROM d),
r AS (SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM g),
s AS (SELECT doc_id, run, min(p) AS a, max(p) + 399 AS b FROM r GROUP BY ALL),
c AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM s),
e AS (SELECT doc_id, sum(b - a + 1) AS n_removed, count(*) AS n_spans, max(b) AS last,
             string_agg(substr(h.t, 2 * before + 1, 2 * (a - 1 - before)), '' ORDER BY a) AS kept
      FROM c JOIN h USING (doc_id) GROUP BY doc_id)
SELECT h.doc_id, CAST(length(h.t) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN last IS NULL THEN h.t ELSE kept || substr(h.t, 2 * last + 1) END)) AS kept_sha256
FROM h LEFT JOIN e USING (doc_id)"""


@query("op8_suffix_array_dedup", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.llm.suffixes import remove_repeated_bytes

    done = remove_repeated_bytes(table(spark, sf_dir, "documents"))
    return done.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


OP9_SQL = """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
w AS (SELECT doc_id, unnest(generate_series(1, len(words) - 12)) AS p, words FROM d WHERE len(words) >= 13),
k AS (SELECT doc_id, p, array_to_string(words[p : p + 12], ' ') AS win FROM w),
later AS (SELECT doc_id, p FROM k QUALIFY doc_id > min(doc_id) OVER (PARTITION BY win)),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(p, p + 12)) AS i FROM later),
words AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM d),
kept AS (SELECT words.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY words.i) AS t
         FROM words ANTI JOIN gone ON words.doc_id = gone.doc_id AND words.i = gone.i GROUP BY 1)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id"""


@query("op9_substring_dedup", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.llm.substrings import remove_repeated_spans

    done = remove_repeated_spans(table(spark, sf_dir, "documents"))
    return done.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


OP2_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
           FROM embeddings
           WHERE embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, v.vec_id,
             CAST(list_sum(list_transform(list_zip(q.e, v.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM v q JOIN v ON v.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS "rank",
       vec_id, score
FROM s QUALIFY "rank" <= 5"""


@query("op2_exact_top_k", OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.llm.topk import top_inner_products

    return top_inner_products(table(spark, sf_dir, "embeddings"))


@query("op4_simhash_near_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


@query("op1_sentencepiece")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.llm.pieces import SPACE, round_trip

    documents = table(spark, sf_dir, "documents")
    both = documents.select("doc_id", "text", round_trip(spark, F.col("text")).alias("both"))
    return both.select("doc_id", "text", "both.*").select(
        "doc_id",
        F.size("ids").cast("long").alias("n_pieces"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.col("decoded") == F.translate("text", SPACE, " ")).alias("round_trip"),
        "ids",
    )


@query("op5_quality_classifier")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.llm.quality import quality

    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op6_toxicity")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.llm.toxicity import toxicity

    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op10_language_id")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.llm.language import languages

    return languages(table(spark, sf_dir, "documents"))


# Windows that hold enough text, and no longer do without their first or without their last line: together they
# are all runs of enough text that stand twice.
OP3_SQL = """
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL),
c AS (SELECT doc_id, l, list_transform(l, lambda x: length(x) + 1) AS n FROM d),
p AS (SELECT doc_id, l, n, unnest(generate_series(1, len(l))) AS i FROM c),
k AS (SELECT doc_id, i, w, array_to_string(l[i : i + w - 1], chr(10)) AS s FROM p, range(1, 41) v(w)
      WHERE i + w - 1 <= len(l) AND list_sum(n[i : i + w - 1]) >= 40
        AND (w = 1 OR list_sum(n[i : i + w - 2]) < 40 OR list_sum(n[i + 1 : i + w - 1]) < 40)),
later AS (SELECT doc_id, i, w FROM k QUALIFY row_number() OVER (PARTITION BY w, s ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + w - 1)) AS i FROM later),
runs AS (SELECT doc_id, count(*) AS n_removed, count(*) FILTER (WHERE fresh) AS n_runs
         FROM (SELECT doc_id, i <> 1 + coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -9) AS fresh FROM gone)
         GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(l[i], chr(10) ORDER BY i) AS t FROM p ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(len(string_split(text, chr(10))), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs,
       CASE WHEN text IS NOT NULL THEN sha256(coalesce(t, '')) END AS kept_sha256
FROM documents LEFT JOIN runs USING (doc_id) LEFT JOIN kept USING (doc_id)"""


@query("op3_line_dedup", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.llm.lines import remove_repeated_lines

    done = remove_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), report="found")
    return done.select("doc_id", "found.*", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@query("op7_benchmark_decontamination")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.llm.decontamination import contaminated

    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("_id").alias("doc_id"), "item_id", "n_windows")


OP13_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
c AS (SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
             CAST('0x' || h[17:24] AS BIGINT) % 100 AS h3, CAST('0x' || h[25:32] AS BIGINT) % 100 AS h4 FROM d),
p AS (SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 >= 90 THEN 'plain'
                  WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form FROM c),
s AS (SELECT *, substr(t, 1, a) AS x, substr(t, a + 1, b - a) AS y, substr(t, b + 1) AS z FROM p)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || x || '<S>' || z || '<M>' || y
                        ELSE '<S>' || z || '<P>' || x || '<M>' || y END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM s"""


@query("op13_fill_in_middle", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.llm.infill import fill_in_middle, restored

    made = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(), 256).alias("restored_sha256"),
    )


# The cheapest repair of each prefix for each state of the grammar (1 nothing, 2 system, 3 user, 4 assistant),
# as (cost, audit, repaired text); each turn may have insertions before it.
OP12_SQL = r"""
WITH RECURSIVE k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
c0 AS (SELECT CAST(i AS UINTEGER) AS b, CAST(i AS UINTEGER) AS r, 0 AS n FROM range(256) t(i) UNION ALL
  SELECT b, CAST(CASE WHEN r & 1 = 1 THEN xor(3988292384, r >> 1) ELSE r >> 1 END AS UINTEGER), n + 1 FROM c0 WHERE n < 8),
crc AS (SELECT list(r ORDER BY b) AS t FROM c0 WHERE n = 8),
d AS (SELECT k.*, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), list_transform(string_split(key, ''), lambda x: CAST(ascii(x) AS UBIGINT))),
                  lambda a, x: xor(a >> 8, CAST(t[CAST(xor(a, x) & 255 AS BIGINT) + 1] AS UBIGINT)))) % 20 AS kind FROM k, crc),
m AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
             CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(generate_series(0, CASE WHEN kind = 3 THEN 1 ELSE 0 END)) AS copy FROM d WHERE kind <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM m),
f AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen,
             regexp_extract(text, '([^ 	-
])[ 	-
]*$', 1) AS tail,
             left(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1) || left(role, 1) AS two FROM o),
j AS (SELECT *, tail = '' AS blank, tail <> '' AND seen AS dup, tail <> '' AND NOT seen AND tail NOT IN ('.', '!', '?') AS short FROM f),
g AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank,
             count(*) FILTER (WHERE dup) AS duplicate, count(*) FILTER (WHERE short) AS truncated,
             count(*) FILTER (WHERE i > 1 AND two NOT IN ('su', 'ua', 'au')) AS illegal,
             list({k: left(role, 1), gone: blank OR dup, c: CAST(short AS INTEGER), line: role || ':' || text, text: text} ORDER BY i) AS turns,
             count(*) AS n
      FROM j GROUP BY conv_id),
step AS (
  SELECT conv_id, 0 AS i, [{c: 0, a: '', r: ''}, {c: 9999999, a: '', r: ''}, {c: 9999999, a: '', r: ''}, {c: 9999999, a: '', r: ''}] AS b FROM g
  UNION ALL
  SELECT s.conv_id, s.i + 1, [
    {c: u[1].c + 3, a: u[1].a || 'D', r: u[1].r},
    list_min([{c: u[2].c + 3, a: u[2].a || 'D', r: u[2].r},
      {c: CASE WHEN t.k = 's' AND NOT t.gone THEN u[1].c + t.c ELSE 9999999 END, a: u[1].a || 'K', r: u[1].r || t.line || chr(10)}]),
    list_min([{c: u[3].c + 3, a: u[3].a || 'D', r: u[3].r},
      {c: CASE WHEN t.k = 'u' AND NOT t.gone THEN p.c + t.c ELSE 9999999 END, a: p.a || 'K', r: p.r || t.line || chr(10)},
      {c: CASE WHEN t.gone THEN 9999999 ELSE p.c + t.c + 2 END, a: p.a || 'R', r: p.r || 'user:' || t.text || chr(10)}]),
    list_min([{c: u[4].c + 3, a: u[4].a || 'D', r: u[4].r},
      {c: CASE WHEN t.k = 'a' AND NOT t.gone THEN u[3].c + t.c ELSE 9999999 END, a: u[3].a || 'K', r: u[3].r || t.line || chr(10)},
      {c: CASE WHEN t.gone THEN 9999999 ELSE u[3].c + t.c + 2 END, a: u[3].a || 'R', r: u[3].r || 'assistant:' || t.text || chr(10)}])]
  FROM (SELECT x.*, list_min([u[1], u[2], u[4]]) AS p FROM (
          SELECT y.conv_id, y.i, g.turns[y.i + 1] AS t, [v[1], v[2], v[3],
                 list_min([v[4], {c: v[3].c + 2, a: v[3].a || 'I', r: v[3].r || 'assistant:' || chr(10)}])] AS u
          FROM (SELECT conv_id, i, [b[1], b[2], list_min([b[3]] || list_transform([b[1], b[2], b[4]],
                       lambda q: {c: q.c + 2, a: q.a || 'I', r: q.r || 'user:' || chr(10)})), b[4]] AS v FROM step) y
          JOIN g ON g.conv_id IS NOT DISTINCT FROM y.conv_id WHERE y.i < g.n) x) s),
e AS (SELECT g.*, list_min([b[1], b[4], {c: b[3].c + 2, a: b[3].a || 'I', r: b[3].r || 'assistant:' || chr(10)},
             {c: b[2].c + 4, a: b[2].a || 'II', r: b[2].r || 'user:' || chr(10) || 'assistant:' || chr(10)}]) AS best
      FROM step s JOIN g ON g.conv_id IS NOT DISTINCT FROM s.conv_id AND s.i = g.n)
SELECT a.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(best.c, 0) AS BIGINT) AS cost,
       coalesce(best.a, '') AS audit, sha256(coalesce(left(best.r, -1), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM a.conv_id"""


@query("op12_conversation_repair", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.llm.turns import damage, repair_conversations

    return repair_conversations(damage(table(spark, sf_dir, "conversations")))


@query("op11_html_extraction")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.llm.wrappers import main_text

    return main_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")
