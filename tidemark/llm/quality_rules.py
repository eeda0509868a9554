"""Quality rules as a short-circuit cascade, in DataFrame and SQL functions only.

Every rule is a Boolean expression over the statistics of a text. A bounded sample gives the
share of documents each rule rejects and the seconds it takes; rules are then ordered by
rejections per second, and the verdict is the conjunction in that order, so that a document
rejected by a cheap rule never reaches a dear one. The order never changes the verdict.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, functions as F

SAMPLE_ROWS = 2_000
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
PLACE_BITS = 20

# Name -> (passes, SQL over `text` and the base columns); integer arithmetic only, so that
# every engine decides alike. Texts without words fail the base rule before these.
RULES = {
    "word_length": "word_chars >= 2 * n_words AND word_chars <= 12 * n_words",
    "symbols": "10 * n_symbols <= n_words",
    "dup_lines": "10 * n_dup_lines <= 3 * n_lines",
    "letters": "5 * n_letters >= 3 * word_chars",
    "capitals": "2 * n_capitals <= n_letters",
    "ellipses": "10 * n_ellipses <= 3 * n_lines",
    "exclamations": "5 * n_marks <= n_words",
}

LETTERS = r"length(regexp_replace(text, '[^\\p{L}]+', ''))"

# What each rule reads besides the base columns: name -> SQL over `text`.
MEASURES = {
    "letters": {"n_letters": LETTERS},
    "capitals": {
        "n_letters": LETTERS, "n_capitals": r"length(regexp_replace(text, '[^\\p{Lu}]+', ''))",
    },
    "ellipses": {"n_ellipses": r"size(regexp_extract_all(text, '(\\.\\.\\.|…)[\\x20\\x09\\x0B-\\x0D]*(\\n|$)', 0))"},
    "exclamations": {"n_marks": "regexp_count(text, '!')"},
}


def base_measures(docs: DataFrame) -> DataFrame:
    """Word, symbol, line and repeat counts of every whole text.

    ``n_repeat_words`` counts the words covered by a three-word window that the text holds
    twice or more: every window becomes one long, 44 bits of its hash before 20 bits of its
    place, and the longs are sorted within the text, so that equal windows are neighbours
    (texts over a million words sort structs of two hashes and the place instead). Places of
    repeated windows are sorted and their overlaps taken off. A null text has no words.
    """
    t = F.coalesce(F.col("text"), F.lit(""))
    split = docs.select(
        "doc_id", t.alias("text"),
        F.filter(F.split(t, SPACE), lambda w: w != "").alias("words"),
        F.filter(F.split(t, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    hashed = split.withColumn("h", F.expr("transform(words, w -> xxhash64(w))"))
    grams = hashed.select(
        "doc_id", "text", "words", "lines", "h",
        F.expr(
            f"CASE WHEN size(h) BETWEEN 3 AND {1 << PLACE_BITS} THEN sort_array(transform(sequence(0, size(h) - 3), i -> "
            f"shiftleft(xxhash64(h[i], h[i + 1], h[i + 2]), {PLACE_BITS}) | bigint(i))) ELSE array() END"
        ).alias("packed"),
        F.expr(
            f"CASE WHEN size(h) > {1 << PLACE_BITS} THEN sort_array(transform(sequence(0, size(h) - 3), i -> named_struct("
            "'a', xxhash64(h[i], h[i + 1], h[i + 2]), 'b', xxhash64(7, words[i], words[i + 1], words[i + 2]), 'i', i))) ELSE array() END"
        ).alias("wide"),
    )
    repeated = grams.select(
        "doc_id", "text", "words", "lines",
        F.expr(
            "CASE WHEN size(wide) = 0 THEN sort_array(transform(filter(packed, (g, j) -> "
            f"(j > 0 AND shiftright(get(packed, j - 1), {PLACE_BITS}) = shiftright(g, {PLACE_BITS})) OR "
            f"(j < size(packed) - 1 AND shiftright(get(packed, j + 1), {PLACE_BITS}) = shiftright(g, {PLACE_BITS}))), g -> int(g & {(1 << PLACE_BITS) - 1}))) "
            "ELSE sort_array(transform(filter(wide, (g, j) -> (j > 0 AND get(wide, j - 1).a = g.a AND get(wide, j - 1).b = g.b)"
            " OR (j < size(wide) - 1 AND get(wide, j + 1).a = g.a AND get(wide, j + 1).b = g.b)), g -> g.i)) END"
        ).alias("places"),
    )
    return repeated.select(
        "doc_id", "text",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr(
            "aggregate(transform(places, (p, j) -> least(3, coalesce(get(places, j + 1) - p, 3))), 0L, (n, c) -> n + c)"
        ).alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
    )


def _passes(rule: str) -> Column:
    sql = RULES[rule]
    for name, expression in MEASURES.get(rule, {}).items():
        sql = sql.replace(name, f"({expression})")
    return F.expr(sql)


def order_rules(measured: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """Rules by rejections per second on a sample of at most ``sample_rows`` measured rows.

    The sample decides the order only. Equal rates keep the order of :data:`RULES`.
    """
    sample = measured.limit(sample_rows).persist()
    try:
        seen = sample.agg(
            F.count(F.lit(1)).alias("n"), *[F.count_if(~_passes(name)).alias(name) for name in RULES]
        ).first()
        gain = {}
        for place, name in enumerate(RULES):
            begun = time.perf_counter()
            sample.agg(F.count_if(~_passes(name))).collect()
            seconds = max(time.perf_counter() - begun, 1e-4)
            gain[name] = (-(seen[name] / max(seen["n"], 1)) / seconds, place)
    finally:
        sample.unpersist()
    return sorted(RULES, key=gain.get)


def quality_rules(docs: DataFrame, order: list[str] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per input row with base counts, ``base_failed``, ``kept`` and ``failed_rule``.

    ``failed_rule`` names the first failing rule of the order in use (null when kept). Null and
    empty texts fail the base rule; repeated rows are judged alike, extra columns are ignored
    and an empty table gives an empty result. ``order`` skips the sampling.
    """
    measured = base_measures(docs)
    if order is None:
        order = order_rules(measured, sample_rows)
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    verdict = F.when(base_failed, "base")
    for name in order:  # CASE evaluates its branches in turn and stops at the first that holds
        verdict = verdict.when(~_passes(name), name)
    judged = measured.withColumn("failed_rule", verdict)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"), F.col("failed_rule").isNull().alias("kept"), "failed_rule",
    )


def op3_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return quality_rules(docs).drop("failed_rule")


OP3_SQL = r"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
grams AS (
  SELECT doc_id, unnest(range(0, len(words) - 2)) AS i, words FROM split WHERE len(words) >= 3),
keyed AS (SELECT doc_id, i, words[i + 1] || ' ' || words[i + 2] || ' ' || words[i + 3] AS g FROM grams),
again AS (SELECT doc_id, i FROM keyed QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + d) AS n FROM again, (VALUES (0), (1), (2)) AS v(d) GROUP BY doc_id),
base AS (
  SELECT s.doc_id, s.text, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(s.text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(s.text) - length(regexp_replace(s.text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words, len(lines) AS n_lines,
    length(regexp_replace(s.text, '[^\p{L}]', '', 'g')) AS n_letters,
    length(regexp_replace(s.text, '[^\p{Lu}]', '', 'g')) AS n_capitals,
    len(regexp_extract_all(s.text, '(\.\.\.|…)[\x20\x09\x0B-\x0D]*(\n|$)')) AS n_ellipses,
    length(s.text) - length(replace(s.text, '!', '')) AS n_marks
  FROM split s LEFT JOIN covered c USING (doc_id)),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_chars >= 2 * n_words AND word_chars <= 12 * n_words AND 10 * n_symbols <= n_words
  AND 10 * n_dup_lines <= 3 * n_lines AND 5 * n_letters >= 3 * word_chars AND 2 * n_capitals <= n_letters
  AND 10 * n_ellipses <= 3 * n_lines AND 5 * n_marks <= n_words AS kept
FROM judged
"""
