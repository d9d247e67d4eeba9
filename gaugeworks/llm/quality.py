"""Quality rules with thresholds the corpus sets for itself.

Each measure is an integer. A sketch counts its values in buckets that keep the
leading bits (relative error under 1/128); sketches of sources add up to those of
languages, and those to one of everything. A group's threshold is its median plus
a multiple of the spread below the median, so neither a few nor many bad documents
move it. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.llm.store import fresh, written
from gaugeworks.llm.words import WORD

GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
KEPT_BITS = 8
#: A group with fewer documents uses the sketch of its language, then the one of all.
LEAST_DOCUMENTS = 100
#: Spreads between the median and a threshold.
REACH = 8
#: For each measure, its least spread (in thousandths), where a group's documents all but agree.
LEAST_SPREAD = {"symbols": 12, "dup_lines": 60, "repeats": 40, "long_words": 1000, "short_words": 250}


def _let(value: Column, use) -> Column:
    """`use` of the value, which is computed once a row."""
    return F.transform(F.array(value), use)[0]


def _covered(hashes: Column) -> Column:
    """Words inside windows whose hash occurs twice or more; the array has one hash a window."""
    def marked(ordered):
        twice = F.filter(F.transform(ordered, lambda x, i: F.when(
            (F.get(ordered, i - 1)["h"] == x["h"]) | (F.get(ordered, i + 1)["h"] == x["h"]), x["i"])),
            lambda i: i.isNotNull())
        return _let(F.sort_array(twice), lambda at: F.aggregate(
            F.transform(at, lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(at, j + 1) - p, F.lit(WINDOW)))),
            F.lit(0).cast("long"), lambda total, x: total + x.cast("long")))
    return _let(F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), marked)


def _repeat_words(words: Column) -> Column:
    def counted(hashed):
        windows = F.transform(F.slice(hashed, F.lit(1), F.size(hashed) - (WINDOW - 1)),
                              lambda x, i: F.xxhash64(F.slice(hashed, i + 1, F.lit(WINDOW))))
        return F.when(F.size(hashed) < WINDOW, F.lit(0).cast("long")).otherwise(_let(windows, lambda w: F.when(
            F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(_covered(w))))
    return _let(F.transform(words, lambda w: F.xxhash64(w)), counted)


def measured(df: DataFrame) -> DataFrame:
    """`df` with its counts: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and n_lines.

    A null or empty text has 0 of each. `n_lines` are the lines with a word.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    put = fresh(df, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
    counts = fresh(df, "counts_of_words", "counts_of_lines")
    return (df.withColumn(counts[0], _let(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda w: F.struct(
                F.size(w).cast("long").alias("n"), _repeat_words(w).alias("again"))))
            .withColumn(counts[1], _let(lines, lambda x: F.struct(
                F.size(x).cast("long").alias("n"),
                (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("again"))))
            .select(*(F.col(f"`{c}`") for c in df.columns), F.col(f"{counts[0]}.n").alias(put[0]),
                    F.length(F.regexp_replace(text, GAP, "")).cast("long").alias(put[1]),
                    (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias(put[2]),
                    F.col(f"{counts[1]}.again").alias(put[3]), F.col(f"{counts[0]}.again").alias(put[4]),
                    F.col(f"{counts[1]}.n").alias(put[5])))


#: What the rules compare, in thousandths; a document without words has none.
MEASURES = {
    "symbols": "1000 * n_symbols div nullif(word_chars, 0)",
    "dup_lines": "1000 * n_dup_lines div nullif(n_lines, 0)",
    "repeats": "1000 * n_repeat_words div nullif(n_words, 0)",
    "long_words": "1000 * word_chars div nullif(n_words, 0)",
    "short_words": "1000 * word_chars div nullif(n_words, 0)",
}
#: These are bad where they are small.
FROM_BELOW = ("short_words",)


def _bucket(v: str) -> str:
    """The value with all but its leading bits cleared."""
    drop = f"greatest(length(bin({v})) - {KEPT_BITS}, 0)"
    return f"shiftleft(shiftright({v}, {drop}), {drop})"


def sketched(counts: DataFrame) -> DataFrame:
    """(lang, source, measure, bucket, n): the mergeable sketches, counted before any row is moved."""
    each = F.array(*(F.struct(F.lit(k).alias("measure"), F.expr(v).alias("v")) for k, v in MEASURES.items()))
    return (counts.filter("n_words > 0").select("lang", "source", F.explode(each).alias("x"))
            .select("lang", "source", "x.measure", F.expr(_bucket("x.v")).alias("bucket"))
            .groupBy("lang", "source", "measure", "bucket").agg(F.count("*").alias("n")))


def thresholds(sketch: DataFrame) -> DataFrame:
    """(lang, source) and, for each measure, the value beyond which a document fails."""
    levels = sketch.select(F.explode(F.array(
        F.struct(F.lit(0).alias("level"), "lang", "source"),
        F.struct(F.lit(1).alias("level"), "lang", F.lit(None).cast("string").alias("source")),
        F.struct(F.lit(2).alias("level"), F.lit(None).cast("string").alias("lang"),
                 F.lit(None).cast("string").alias("source")))).alias("g"), "measure", "bucket", "n")
    merged = levels.groupBy("g", "measure", "bucket").agg(F.sum("n").alias("n"))
    # A group has at most a few thousand buckets, whatever it holds.
    up = Window.partitionBy("g", "measure").orderBy("bucket")
    ranked = merged.withColumn("upto", F.sum("n").over(up)).withColumn(
        "all", F.sum("n").over(Window.partitionBy("g", "measure")))

    def at(share: str) -> Column:
        return F.min(F.when(F.expr(f"upto >= ceil(all * {share})"), F.col("bucket")))

    fences = ranked.groupBy("g", "measure").agg(
        F.max("all").alias("documents"), at("0.25BD").alias("low"), at("0.5BD").alias("mid"), at("0.75BD").alias("high"))
    spread_of = F.create_map(*(F.lit(x) for kv in LEAST_SPREAD.items() for x in kv))[F.col("measure")]
    below = F.greatest(F.col("mid") - F.col("low"), spread_of)
    limit = F.when(F.col("measure").isin(*FROM_BELOW), F.col("mid") - REACH * F.greatest(
        F.least(F.col("high") - F.col("mid"), below), spread_of)).otherwise(F.col("mid") + REACH * below)
    limits = fences.select("g.level", "g.lang", "g.source", "measure", "documents", limit.cast("long").alias("limit"))
    wide = limits.groupBy("level", "lang", "source").agg(
        F.max("documents").alias("documents"),
        F.struct(*(F.max(F.when(F.col("measure") == k, F.col("limit"))).alias(k) for k in MEASURES)).alias("limits"))
    group, tongue, everything = (wide.filter(F.col("level") == k) for k in (0, 1, 2))
    everything = everything.select(F.col("limits").alias("l2"))
    tongue = tongue.select(F.col("lang").alias("lang_1"), F.when(F.col("documents") >= LEAST_DOCUMENTS, F.col("limits")).alias("l1"))
    # One row stands on the right of the second join.
    return (group.join(tongue, F.col("lang").eqNullSafe(F.col("lang_1")), "left").join(everything, F.lit(True), "left")
            .select("lang", "source", F.coalesce(
                F.when(F.col("documents") >= LEAST_DOCUMENTS, F.col("limits")), "l1", "l2").alias("limits")))


def judged(counts: DataFrame) -> DataFrame:
    """`counts` (of `measured`, with lang and source) with base_failed, kept and the rules that failed.

    Base rules: under 20 words, or over 30 % of the words repeated. The others come
    from the sketches of the document's language and source. A null language or
    source is a group like any other. Repeated rows are judged alike; an empty
    table gives an empty result.
    """
    limits = thresholds(sketched(counts)).select(
        F.col("lang").alias("lang_of"), F.col("source").alias("source_of"), "limits")
    both = counts.join(written(limits, "limits"), F.col("lang").eqNullSafe(F.col("lang_of"))
                       & F.col("source").eqNullSafe(F.col("source_of")), "left")
    base = F.expr("n_words < 20 OR 100 * n_repeat_words > 30 * n_words")
    fails = F.array_compact(F.array(*(F.when(
        F.expr(v) < F.col(f"limits.{k}") if k in FROM_BELOW else F.expr(v) > F.col(f"limits.{k}"), F.lit(k))
        for k, v in MEASURES.items())))
    return (both.withColumn("base_failed", base).withColumn("failed", fails)
            .withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))
            .drop("lang_of", "source_of", "limits"))


def quality(df: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed, kept and failed rules for each row of `df` (doc_id, text, lang, source)."""
    counts = written(measured(df.select("doc_id", "text", "lang", "source")).drop("text"), "counts")
    return judged(counts).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                 "base_failed", "kept", "failed")


def _duck_bucket(v: str) -> str:
    drop = f"greatest(length(bin({v})) - {KEPT_BITS}, 0)::INTEGER"
    return f"((({v}) >> {drop}) << {drop})"


def _oracle() -> str:
    each = ", ".join(f"{{'measure': '{k}', 'v': {v.replace(' div ', ' // ')}}}" for k, v in MEASURES.items())
    spread = " ".join(f"WHEN '{k}' THEN {v}" for k, v in LEAST_SPREAD.items())
    fail = " OR ".join(f"m.{k} {'<' if k in FROM_BELOW else '>'} l.{k}" for k in MEASURES)
    mine = ", ".join(f"{v.replace(' div ', ' // ')} AS {k}" for k, v in MEASURES.items())
    limits = ", ".join(f"max(CASE WHEN measure = '{k}' THEN lim END) AS {k}" for k in MEASURES)
    pick = ", ".join(f"CASE WHEN a.documents >= {LEAST_DOCUMENTS} THEN a.{k} WHEN b.documents >= {LEAST_DOCUMENTS} "
                     f"THEN b.{k} ELSE c.{k} END AS {k}" for k in MEASURES)
    return rf"""
WITH w AS (SELECT doc_id, lang, source, coalesce(text, '') AS text,
                  regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS ls
           FROM documents),
nw AS (SELECT *, row_number() OVER () AS r FROM w),
g AS (SELECT r, i, array_to_string(ws[i:i + {WINDOW - 1}], ' ') AS win
      FROM (SELECT r, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM nw WHERE len(ws) >= {WINDOW})),
d AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS c FROM g) WHERE c > 1),
s AS (SELECT r, sum(least({WINDOW}, coalesce(nx - i, {WINDOW})))::BIGINT AS again
      FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nx FROM d) GROUP BY r),
k AS (SELECT nw.r, doc_id, lang, source, len(ws)::BIGINT AS n_words,
             length(regexp_replace(text, '{GAP}', '', 'g'))::BIGINT AS word_chars,
             (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls)::BIGINT AS n_lines,
             coalesce(again, 0)::BIGINT AS n_repeat_words
      FROM nw LEFT JOIN s USING (r)),
b AS (SELECT lang, source, x.measure AS measure, {_duck_bucket('x.v')} AS bucket
      FROM (SELECT lang, source, unnest([{each}]) AS x FROM k WHERE n_words > 0)),
lv AS (SELECT 0 AS level, lang, source, measure, bucket FROM b
       UNION ALL SELECT 1, lang, NULL, measure, bucket FROM b
       UNION ALL SELECT 2, NULL, NULL, measure, bucket FROM b),
c AS (SELECT level, lang, source, measure, bucket, count(*) AS n FROM lv GROUP BY ALL),
u AS (SELECT *, sum(n) OVER (PARTITION BY level, lang, source, measure ORDER BY bucket) AS upto,
             sum(n) OVER (PARTITION BY level, lang, source, measure) AS al FROM c),
f AS (SELECT level, lang, source, measure, max(al) AS documents,
             min(CASE WHEN upto >= ceil(al * 0.25) THEN bucket END) AS low,
             min(CASE WHEN upto >= ceil(al * 0.5) THEN bucket END) AS mid,
             min(CASE WHEN upto >= ceil(al * 0.75) THEN bucket END) AS high,
             CASE measure {spread} END AS least_ FROM u GROUP BY level, lang, source, measure),
t AS (SELECT level, lang, source, documents, measure, CASE WHEN measure = 'short_words'
             THEN mid - {REACH} * greatest(least(high - mid, greatest(mid - low, least_)), least_)
             ELSE mid + {REACH} * greatest(mid - low, least_) END AS lim FROM f),
p AS (SELECT level, lang, source, max(documents) AS documents, {limits} FROM t GROUP BY level, lang, source),
l AS (SELECT a.lang, a.source, {pick} FROM (SELECT * FROM p WHERE level = 0) a
      JOIN (SELECT * FROM p WHERE level = 1) b ON a.lang IS NOT DISTINCT FROM b.lang, (SELECT * FROM p WHERE level = 2) c),
m AS (SELECT *, {mine} FROM k)
SELECT m.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND NOT coalesce({fail}, false) AS kept
FROM m LEFT JOIN l ON m.lang IS NOT DISTINCT FROM l.lang AND m.source IS NOT DISTINCT FROM l.source
"""


ORACLE = _oracle()
