"""Queries over review findings, votes, manifests and materials, derived from `documents`."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugeworks import fixed
from gaugeworks.catalog.base import Inputs, built, query, view
from gaugeworks.functions import text as tx
from gaugeworks.operators import findings as fi, grading, manifests, materials, votes
from gaugeworks.sources import readers

_CATS = list(fixed.QUALITY_CATEGORIES)
_CASE = "CASE (j * 5 + k) % 16 " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(_CATS)) + " END"

# A finding per document and reading; a criterion is a number within its task.
view("finding_rows", f"""
SELECT run_id AS task_id, doc_id, reading, {_CASE} AS category,
  CASE WHEN {_CASE} LIKE 'missing%' THEN '' ELSE 'line ' || CAST(j % 10 AS STRING) END AS criterion,
  'f' || CAST(CASE WHEN {_CASE} LIKE 'missing%' THEN n_chars % 3 ELSE j % 10 END AS STRING) || '-' || {_CASE} AS finding_id,
  CASE WHEN n_chars % 9 = 0 THEN 'by hand' ELSE '' END AS exempt, n_chars % 3 <> 0 AS from_run, n_chars % 5 = 0 AS covered,
  CASE WHEN {_CASE} = 'overlapping' THEN 'line ' || CAST((j + 3) % 10 AS STRING) END AS other_criterion,
  CAST(j AS INT) AS index, 's' || CAST(j % 4 AS STRING) AS statement_id, text, n_chars
FROM (SELECT *, 1 AS reading FROM {{lines_base}} UNION ALL SELECT *, 2 FROM {{lines_base}} UNION ALL SELECT *, 3 FROM {{lines_base}}) r
WHERE r.reading = 1 OR n_chars % (r.reading + 1) = 0""")

_SEV = "CASE category " + " ".join(f"WHEN '{c}' THEN '{v[1]}'" for c, v in fixed.QUALITY_CATEGORIES.items()) + " END"
_COUNT = "CASE category " + " ".join(f"WHEN '{c}' THEN '{v[2]}'" for c, v in fixed.QUALITY_CATEGORIES.items() if v[2]) + " END"
_GROUP = "CASE category " + " ".join(f"WHEN '{c}' THEN '{v[0]}'" for c, v in fixed.QUALITY_CATEGORIES.items()) + " END"


@built("reproduced", """
SELECT * EXCLUDE (rn, reading), (SELECT count(DISTINCT reading) FROM {finding_rows} x WHERE x.task_id = f.task_id AND x.finding_id = f.finding_id) AS samples
FROM (SELECT *, row_number() OVER (PARTITION BY task_id, finding_id ORDER BY doc_id) AS rn FROM {finding_rows} WHERE reading = 1) f WHERE rn = 1""")
def reproduced(t: Inputs):
    first = t.finding_rows.where("reading = 1").groupBy("task_id", "finding_id").agg(F.min("doc_id").alias("doc_id"))
    rows = t.finding_rows.join(first.select("task_id", "finding_id", F.col("doc_id").alias("_d")), ["task_id", "finding_id"], "left")
    return fi.reproduced(rows.where("reading <> 1 OR doc_id = _d").drop("_d"))


@built("classed", f"""
SELECT *, {_GROUP} AS "group", {_SEV} AS severity, CASE WHEN exempt <> '' THEN NULL
  WHEN {_COUNT} = 'generality' THEN CASE WHEN from_run AND NOT covered THEN 'generality' END ELSE {_COUNT} END AS counts_toward
FROM {{reproduced}}""")
def classed(t: Inputs):
    return fi.classified(t.reproduced)


view("written", "SELECT run_id AS task_id, count(*) * CASE WHEN min(doc_id) % 7 = 0 THEN 0 ELSE 3 END AS criteria_written FROM {lines_base} GROUP BY run_id")


@built("quality", """
WITH u AS (SELECT task_id, CASE WHEN criterion <> '' THEN 'c|' || criterion ELSE 'm|' || finding_id END AS un,
    max(CASE severity WHEN 'major' THEN 3 WHEN 'moderate' THEN 2 WHEN 'minor' THEN 1 ELSE 0 END) AS r
  FROM {classed} WHERE counts_toward = 'quality' AND severity <> 'note' GROUP BY ALL),
c AS (SELECT task_id, count(*) AS units, count(*) FILTER (r = 3) AS major, count(*) FILTER (r = 2) AS moderate, count(*) FILTER (r = 1) AS minor FROM u GROUP BY 1),
e AS (SELECT task_id, count(DISTINCT criterion) AS escapes FROM {classed} WHERE counts_toward = 'generality' GROUP BY 1),
l AS (SELECT task_id, criteria_written AS n, coalesce(units, 0) AS units, coalesce(major, 0) AS major, coalesce(moderate, 0) AS moderate,
    coalesce(minor, 0) AS minor, coalesce(escapes, 0) AS escapes FROM {written} LEFT JOIN c USING (task_id) LEFT JOIN e USING (task_id)),
k AS (SELECT task_id, min(x) AS k FROM (SELECT l.*, g.x FROM l, range(0, 60) g(x) WHERE g.x <= units
    AND NOT (greatest(0, major - x) * 100 > 10 * n OR (greatest(0, major - x) + greatest(0, moderate - greatest(0, x - major))) * 100 > 15 * n OR (units - x) * 100 > 20 * n)) GROUP BY 1)
SELECT task_id, n AS criteria_written, units, major, moderate, minor, escapes,
  n > 0 AND (major * 100 > 10 * n OR (major + moderate) * 100 > 15 * n OR units * 100 > 20 * n) AS quality_over,
  n > 0 AND escapes * 100 > 5 * n AS generality_over,
  n > 0 AND (major * 100 > 10 * n OR (major + moderate) * 100 > 15 * n OR units * 100 > 20 * n OR escapes * 100 > 5 * n) AS over,
  CASE WHEN n > 0 THEN k + greatest(0, escapes - CAST(floor(5 * n / 100) AS BIGINT)) ELSE 0 END AS to_clear
FROM l JOIN k USING (task_id)""")
def quality(t: Inputs):
    return fi.quality_line(t.classed, t.written)


@query("a41_reproduced_findings", "SELECT task_id, finding_id, samples FROM {reproduced}")
def a41(t):
    return t.reproduced.select("task_id", "finding_id", "samples")


@query("a32_quality_line", "SELECT * EXCLUDE (to_clear) FROM {quality}")
def a32(t):
    return t.quality.drop("to_clear")


@query("w09_fewest_repairs", "SELECT task_id, to_clear FROM {quality}")
def w09(t):
    return t.quality.select("task_id", "to_clear")


@query("a33_review_grade", """
SELECT task_id, CASE WHEN criteria_written <= 0 THEN 'UNMEASURED' WHEN over THEN 'FAIL'
  WHEN major = 0 AND moderate = 0 AND escapes = 0 AND minor * 100 < 5 * criteria_written THEN 'CLEAN' ELSE 'ISSUE' END AS review,
  round(major / nullif(criteria_written, 0)::DOUBLE, 4) AS pct_major, round((major + moderate) / nullif(criteria_written, 0)::DOUBLE, 4) AS pct_major_moderate,
  round(units / nullif(criteria_written, 0)::DOUBLE, 4) AS pct_any FROM {quality}""")
def a33(t):
    return fi.review_grade(t.quality)


view("unread_groups", "SELECT run_id AS task_id, 'weights' AS name FROM {lines_base} WHERE n_chars % 97 = 0")


@query("a34_review_verdict", """
SELECT task_id, CASE WHEN over THEN 'FAIL' WHEN task_id IN (SELECT task_id FROM {unread_groups}) OR task_id IN
  (SELECT task_id FROM {classed}) THEN 'WARN' ELSE 'PASS' END AS verdict FROM {quality}""")
def a34(t):
    return fi.review_verdict(t.quality, t.classed, t.unread_groups)


@query("t13_proven_overlaps", """
SELECT task_id, finding_id, CASE WHEN category = 'overlapping' AND exempt IN ('', 'proven') THEN CASE WHEN (right(criterion, 1) IN ('0','2','4','6','8'))
    <> (right(other_criterion, 1) IN ('0','2','4','6','8')) AND CASE WHEN right(criterion, 1) IN ('0','2','4','6','8') THEN right(other_criterion, 1) ELSE right(criterion, 1) END IN ('1', '5', '7')
  THEN 'proven' ELSE '' END ELSE exempt END AS exempt FROM {reproduced}""")
def t13(t):
    lines = t.finding_rows.where("criterion <> ''").select("task_id", "criterion").unionByName(
        t.finding_rows.where("other_criterion IS NOT NULL").select("task_id", F.col("other_criterion").alias("criterion")))
    digit = F.right("criterion", F.lit(1)).cast("int")
    weights = lines.withColumn("weight", F.when(digit % 2 == 0, 3).otherwise(-3))
    fired = lines.withColumn("fired", digit.isin(1, 5, 7))
    return fi.apply_fired(t.reproduced, weights, fired).select("task_id", "finding_id", "exempt")


@query("t14_unconfirmed_statements", """
SELECT task_id, finding_id, CASE WHEN category = 'incorrect_criteria' AND exempt IN ('', 'unconfirmed') THEN
  CASE WHEN statement_id IN ('s1', 's3') THEN '' ELSE 'unconfirmed' END ELSE exempt END AS exempt FROM {reproduced}""")
def t14(t):
    confirmed = t.finding_rows.select("task_id", "statement_id").distinct().withColumn(
        "confirmed", F.col("statement_id").isin("s1", "s3"))
    return fi.apply_statements(t.reproduced, confirmed).select("task_id", "finding_id", "exempt")


@query("j32_separated_overlaps", """
SELECT task_id, finding_id FROM {reproduced} r WHERE category = 'overlapping' AND NOT EXISTS (SELECT 1 FROM {finding_rows} s
  WHERE s.task_id = r.task_id AND s.n_chars % 4 = 1 AND 'line ' || (s.n_chars % 10) = r.criterion AND 'line ' || ((s.n_chars + 3) % 10) = r.other_criterion)""")
def j32(t):
    apart = t.finding_rows.where("n_chars % 4 = 1").select(
        "task_id", F.concat(F.lit("line "), (F.col("n_chars") % 10).cast("string")).alias("criterion"),
        F.concat(F.lit("line "), ((F.col("n_chars") + 3) % 10).cast("string")).alias("other_criterion"))
    return fi.without_separated(t.reproduced.where("category = 'overlapping'"), apart).select("task_id", "finding_id")


view("overlap_findings", """
SELECT run_id AS task_id, CASE WHEN j % 2 = 0 THEN 'Line  ' ELSE 'line ' END || CAST(n_chars % 12 AS STRING) AS criterion, 'line ' || CAST((n_chars * 5 + j) % 12 AS STRING) AS other_criterion,
  CASE WHEN j % 6 = 5 THEN NULL ELSE CAST(j % 6 AS INT) END AS index, 'f' || CAST(doc_id AS STRING) AS finding_id,
  CASE WHEN n_chars % 13 = 0 THEN 'proven' ELSE '' END AS exempt, CASE WHEN n_chars % 11 = 0 THEN 1 ELSE 3 END AS samples FROM {lines_base}""")


@query("w11_repeats", r"""
WITH RECURSIVE f AS (SELECT *, row_number() OVER (PARTITION BY task_id ORDER BY index IS NULL, coalesce(index, 0), finding_id) AS rn FROM (
    SELECT task_id, criterion, lower(regexp_replace(criterion, '\s+', ' ', 'g')) AS line, other_criterion AS other, index, finding_id FROM {overlap_findings}
    WHERE exempt = '' AND samples >= 3) WHERE line <> other),
g AS (SELECT DISTINCT task_id, 0 AS i, CAST([] AS VARCHAR[]) AS gone, CAST([] AS VARCHAR[]) AS named FROM f
  UNION ALL SELECT g.task_id, i + 1, CASE WHEN list_contains(gone, line) OR list_contains(gone, other) THEN gone ELSE list_append(gone, line) END,
    CASE WHEN list_contains(gone, line) OR list_contains(gone, other) THEN named ELSE list_append(named, criterion) END
  FROM g JOIN f ON f.task_id = g.task_id AND f.rn = i + 1)
SELECT task_id, unnest(named) AS criterion FROM g QUALIFY i = max(i) OVER (PARTITION BY task_id)""")
def w11(t):
    return fi.repeats(t.overlap_findings)


@query("a35_distinct_checks", """
SELECT task_id AS run_id, checks, repeats, checks - repeats AS distinct_checks, checks - repeats >= 20 AS distinct_enough FROM (
  SELECT run_id AS task_id, count(*) AS checks, count(*) FILTER (n_chars % 5 = 0) AS repeats FROM {lines_base} GROUP BY run_id)""")
def a35(t):
    counts = t.lines_base.groupBy("run_id").agg(F.count("*").alias("checks"))
    return grading.distinct_checks(counts, t.lines_base.where("n_chars % 5 = 0").select("run_id"))


view("raw_findings", """
SELECT run_id AS task_id, doc_id, CASE WHEN n_chars % 7 = 0 THEN 'made_up' WHEN n_chars % 7 = 1 THEN 'double_negative' ELSE 'incorrect_weight_minor' END AS category,
  CASE WHEN j % 8 = 0 THEN '' WHEN j % 8 = 1 THEN 'Line  NINE' ELSE 'Line ' || CAST(j % 6 AS STRING) END AS criterion,
  CASE WHEN k % 5 = 0 THEN 'It is arguably off' WHEN k % 5 = 1 THEN ' ' ELSE 'It is off' END AS what,
  CASE WHEN n_chars % 7 >= 2 THEN CAST(CASE n_chars % 4 WHEN 0 THEN 5 WHEN 1 THEN 3 WHEN 2 THEN -3 ELSE 2 END AS INT) END AS proposed_weight FROM {lines_base}""")
view("criterion_lines", """
SELECT DISTINCT run_id AS task_id, 'line ' || CAST(j % 6 AS STRING) AS criteria, CAST(CASE j % 6 WHEN 0 THEN 5 WHEN 1 THEN 3 WHEN 2 THEN 1 WHEN 3 THEN -1
  WHEN 4 THEN -3 ELSE -5 END AS INT) AS weight FROM {lines_base}""")


@query("t15_evidence_filter", """
WITH x AS (SELECT f.*, c.weight, list_position([5, 3, 1, -1, -3, -5], c.weight) - list_position([5, 3, 1, -1, -3, -5], proposed_weight) AS d,
  trim(lower(regexp_replace(criterion, '\\s+', ' ', 'g'))) AS cn FROM {raw_findings} f LEFT JOIN {criterion_lines} c ON c.task_id = f.task_id
  AND c.criteria = trim(lower(regexp_replace(criterion, '\\s+', ' ', 'g'))))
SELECT task_id, doc_id, CASE WHEN proposed_weight IN (5, 3, -3) AND abs(d) > 1 THEN 'incorrect_weight_major' WHEN proposed_weight IN (5, 3, -3) AND abs(d) = 1
    THEN 'incorrect_weight_minor' ELSE category END AS category,
  CASE WHEN category = 'made_up' THEN 'unknown category' WHEN trim(what) = '' THEN 'no claim' WHEN contains(what, 'arguably') THEN 'hedged'
  WHEN cn = '' THEN 'no criterion named' WHEN weight IS NULL THEN 'no such criterion' WHEN category = 'double_negative' AND weight > 0 THEN 'not a negative line'
  WHEN proposed_weight = 2 THEN 'weight off the scale' WHEN d = 0 THEN 'weight it already has' ELSE 'kept' END AS why FROM x""")
def t15(t):
    kept, dropped = fi.evidence_filter(t.raw_findings, t.criterion_lines)
    both = kept.withColumn("why", F.lit("kept")).unionByName(dropped)
    return both.select("task_id", "doc_id", "category", "why")


@query("t16_reply_rows", """
SELECT task_id, category, count(*) AS n FROM (
  SELECT run_id AS task_id, 'subjective' AS category FROM {lines_base} WHERE n_chars % 3 = 0 UNION ALL
  SELECT run_id, 'incorrect_weight_minor' FROM {lines_base} WHERE n_chars % 3 = 1 AND n_chars % 2 = 0 UNION ALL
  SELECT run_id, CASE WHEN j % 2 = 0 THEN 'missing_critical' ELSE 'missing_noncritical' END FROM {lines_base} WHERE n_chars % 4 = 0 UNION ALL
  SELECT run_id, 'missing_critical' FROM {lines_base} WHERE n_chars % 5 <> 0 UNION ALL
  SELECT run_id, 'hallucination_generality' FROM {lines_base} WHERE n_chars % 6 = 0) GROUP BY ALL""")
def t16(t):
    n, none = F.col("n_chars"), F.array().cast("array<string>")
    name = F.concat(F.lit("line "), F.col("j").cast("string"))
    some = F.array(F.lit("1"))
    replies = t.lines_base.select(
        F.col("run_id").alias("task_id"), F.lit(1).alias("reading"),
        F.array(F.struct(F.when(n % 3 == 0, "subjective").when(n % 3 == 2, " Clean ").alias("verdict"), name.alias("criterion"),
                         F.when(n % 3 == 1, 3).alias("bucket"), F.when(n % 2 == 0, 5).otherwise(3).alias("carried"),
                         F.lit(True).alias("clear"))).alias("verdicts"),
        F.array(F.struct(F.when(n % 4 == 0, none).otherwise(some).alias("covered_by"), (F.col("j") % 2 == 0).alias("critical"),
                         F.col("text").alias("prompt_quote"))).alias("requirements"),
        F.array(F.struct(F.when(n % 5 != 0, none).otherwise(some).alias("covered_by"), F.col("text").alias("answer_quote"))).alias("annotations"),
        F.array(F.struct(F.when(n % 6 == 0, "Escapable").otherwise("holds").alias("verdict"), name.alias("criterion"),
                         F.col("text").alias("particular"))).alias("escape_verdicts"))
    return fi.reply_rows(replies).groupBy("task_id", "category").agg(F.count("*").alias("n"))


# --- justification findings -----------------------------------------------------

_JC = "CASE n_chars % 8 " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(fixed.JUSTIFICATION_CATEGORIES)) + " ELSE 'other' END"
view("justification_findings", f"""
SELECT run_id AS task_id, doc_id, {_JC} AS category, CASE WHEN j % 11 = 0 THEN '' ELSE 'wrong' END AS what,
  CASE WHEN k % 3 = 0 THEN 'the part ' || CAST(j % 4 AS STRING) ELSE 'not there' END AS quote_norm,
  CASE WHEN j % 2 = 0 THEN 'row ' || CAST(j % 4 AS STRING) END AS material_quote_norm, CAST(j % 3 + 1 AS INT) AS reading FROM {{lines_base}}""")
view("justification_texts", """
SELECT DISTINCT run_id AS task_id, 'we take the part 0, the part 1 and the part 2' AS justification_norm, 'row 0 row 2' AS material_norm FROM {lines_base}""")
_KEPT = """
SELECT * FROM {justification_findings} WHERE category <> 'other' AND what <> '' AND quote_norm IN ('the part 0', 'the part 1', 'the part 2')
  AND NOT (category = 'contradicts_material' AND coalesce(material_quote_norm, '') NOT IN ('row 0', 'row 2'))"""
_BLOCKING = ["no_determiner", "path_left_open", "untrue"]


@query("t17_justification_findings", f"SELECT task_id, doc_id, category FROM ({_KEPT})")
def t17(t):
    return fi.quoted_findings(t.justification_findings, t.justification_texts)[0].select("task_id", "doc_id", "category")


def _merged(t):
    return fi.merged_by_quote(fi.quoted_findings(t.justification_findings, t.justification_texts)[0])


@query("a27_merged_by_quote", f"""
SELECT task_id, category, quote_norm, count(DISTINCT reading) AS samples, min(reading) AS first_reading FROM ({_KEPT}) GROUP BY ALL""")
def a27(t):
    return _merged(t)


@query("k04_findings_in_order", f"""
SELECT task_id, category, quote_norm, samples, b AS blocking, b AND samples >= 2 AS serious FROM (SELECT task_id, category, quote_norm,
  count(DISTINCT reading) AS samples, category IN ('no_determiner', 'path_left_open', 'untrue') AS b FROM ({_KEPT}) GROUP BY ALL)
ORDER BY task_id, serious DESC, blocking DESC, samples DESC, category, quote_norm""")
def k04(t):
    return fi.in_reading_order(_merged(t), _BLOCKING).drop("first_reading")


@query("a34_justification_verdict", f"""
SELECT t.task_id, CASE WHEN bool_or(samples >= 2 AND category IN ('no_determiner', 'path_left_open', 'untrue')) THEN 'FAIL'
  WHEN count(category) > 0 THEN 'WARN' ELSE 'PASS' END AS verdict
FROM (SELECT DISTINCT run_id AS task_id FROM {{lines_base}}) t LEFT JOIN (SELECT task_id, category, quote_norm, count(DISTINCT reading) AS samples
  FROM ({_KEPT}) GROUP BY ALL) m ON m.task_id = t.task_id GROUP BY t.task_id""")
def a34b(t):
    return fi.justification_verdict(_merged(t), t.lines_base.select(F.col("run_id").alias("task_id")).distinct(), _BLOCKING)


@query("a31_classification_consensus", """
WITH s AS (SELECT run_id AS task_id, CAST(n_chars % 5 + 1 AS INT) AS level, CASE n_chars % 3 WHEN 0 THEN 'yes' WHEN 1 THEN 'no' ELSE 'borderline' END AS c FROM {lines_base}),
v AS (SELECT task_id, c, row_number() OVER (PARTITION BY task_id ORDER BY count(*) DESC, c) AS rn FROM s GROUP BY task_id, c),
m AS (SELECT task_id, list_sort(list(level))[CAST(floor((count(*) + 1) / 2) AS BIGINT)] AS level, min(level) AS low, max(level) AS high FROM s GROUP BY 1)
SELECT task_id, level, c AS comprehension, low, high, low < 4 AND high >= 4 AS straddles,
  CASE WHEN c = 'yes' OR level < 4 THEN 'FAIL' WHEN level = 4 OR c = 'borderline' THEN 'WARN' ELSE 'PASS' END AS verdict
FROM m JOIN v USING (task_id) WHERE rn = 1""")
def a31(t):
    samples = t.lines_base.selectExpr("run_id AS task_id", "CAST(n_chars % 5 + 1 AS INT) AS level",
                                      "CASE n_chars % 3 WHEN 0 THEN 'yes' WHEN 1 THEN 'no' ELSE 'borderline' END AS comprehension")
    return fi.classification_consensus(samples)


# --- statements and votes -------------------------------------------------------

view("statement_rows", """
SELECT run_id AS task_id, doc_id, CAST(doc_id AS INT) AS reading_no, CASE WHEN j % 3 = 0 THEN 'ground truth' ELSE 'prompt' END AS file,
  'quote ' || CAST(j % 7 AS STRING) AS quote, 'st' || CAST(j % 3 AS STRING) || '-' || CAST(j % 7 AS STRING) AS statement_id,
  CASE WHEN n_chars % 3 = 0 THEN 'accurate' ELSE 'inaccurate' END AS reading, CASE WHEN n_chars % 5 = 0 THEN 'low' ELSE 'high' END AS confidence,
  CASE WHEN n_chars % 7 = 0 THEN ' ' ELSE 'summed it' END AS check, 'off by one' AS what_is_wrong,
  CASE WHEN n_chars % 2 = 0 THEN 'criterion ' || CAST(j % 4 AS STRING) ELSE 'answer' END AS ref FROM {lines_base}""")


@built("statements", """
SELECT task_id, statement_id, arg_min(file, (NOT f, reading_no)) AS file, arg_min(quote, (NOT f, reading_no)) AS quote, arg_min(reading, (NOT f, reading_no)) AS reading,
  bool_or(f) AS flagged, string_agg(DISTINCT ref, ',' ORDER BY ref) AS bears_on
FROM (SELECT *, reading = 'inaccurate' AND confidence = 'high' AND trim("check") <> '' AS f FROM {statement_rows}) GROUP BY ALL""")
def statements(t: Inputs):
    return votes.merged_statements(t.statement_rows.withColumn("bears_on", F.array("ref")))


@query("a28_merged_statements", "SELECT task_id, statement_id, reading, flagged, bears_on FROM {statements}")
def a28(t):
    return t.statements.select("task_id", "statement_id", "reading", "flagged", F.array_join("bears_on", ",").alias("bears_on"))


@built("ballot", """
WITH n AS (SELECT task_id, count(*) FILTER (flagged) AS n FROM {statements} GROUP BY 1),
d AS (SELECT *, row_number() OVER (PARTITION BY task_id ORDER BY statement_id) AS rn FROM {statements} WHERE NOT flagged)
SELECT task_id, statement_id, flagged, row_number() OVER (PARTITION BY task_id ORDER BY sha256('seed|' || task_id || '|' || statement_id), statement_id) AS place
FROM (SELECT task_id, statement_id, flagged FROM {statements} WHERE flagged UNION ALL
  SELECT d.task_id, statement_id, flagged FROM d JOIN n USING (task_id) WHERE n > 0 AND rn <= greatest(1, n))""")
def ballot(t: Inputs):
    return votes.ballots(t.statements, "seed")


@query("k05_seeded_ballot", "SELECT task_id, statement_id, flagged, place::INT AS place FROM {ballot}")
def k05(t):
    return t.ballot.select("task_id", "statement_id", "flagged", "place")


SLOTS = ["one", "two", "three"]
view("cast_votes", """
SELECT run_id AS task_id, 'st' || CAST(j % 3 AS STRING) || '-' || CAST(j % 7 AS STRING) AS statement_id,
  CASE k % 3 WHEN 2 THEN 'one' ELSE s.slot END AS slot, doc_id * 3 + s.i AS vote_no,
  CASE WHEN n_chars % 11 = 0 THEN 'dunno' WHEN n_chars % 13 = 0 THEN 'Cannot Tell' WHEN n_chars % 4 = 0 THEN 'accurate' ELSE ' Inaccurate' END AS verdict
FROM (SELECT *, 'one' AS slot, 0 AS i FROM {lines_base} UNION ALL SELECT *, 'two', 1 FROM {lines_base} UNION ALL
  SELECT *, 'three', 2 FROM {lines_base}) s WHERE n_chars % 17 <> 3""")


@built("votes_filled", """
SELECT b.task_id, b.statement_id, b.flagged, s.slot, coalesce(CASE WHEN v IN ('accurate', 'inaccurate', 'cannot_tell') THEN v END, 'cannot_tell') AS verdict
FROM {ballot} b CROSS JOIN (VALUES ('one'), ('two'), ('three')) s(slot)
LEFT JOIN (SELECT task_id, statement_id, slot, replace(lower(trim(arg_max(verdict, vote_no))), ' ', '_') AS v FROM {cast_votes} GROUP BY ALL) c
  ON c.task_id = b.task_id AND c.statement_id = b.statement_id AND c.slot = s.slot""")
def votes_filled(t: Inputs):
    return votes.filled_votes(t.ballot, SLOTS, t.cast_votes)


@query("j18_votes_filled", "SELECT task_id, statement_id, slot, verdict FROM {votes_filled}")
def j18(t):
    return t.votes_filled.select("task_id", "statement_id", "slot", "verdict")


@built("outcome", """
SELECT task_id, statement_id, bool_or(flagged) AS flagged, count(*) FILTER (verdict = 'inaccurate') AS called_inaccurate,
  CASE WHEN bool_or(flagged) THEN bool_and(verdict = 'inaccurate') AND (SELECT count(DISTINCT slot) FROM {cast_votes} c WHERE c.task_id = f.task_id) = 3 END AS confirmed
FROM {votes_filled} f GROUP BY task_id, statement_id""")
def outcome(t: Inputs):
    return votes.vote_outcome(t.votes_filled, t.cast_votes, SLOTS)


@query("a29_vote_outcome", "SELECT task_id, statement_id, flagged, called_inaccurate, confirmed FROM {outcome}")
def a29(t):
    return t.outcome


@query("a29_decoys_called", "SELECT task_id, coalesce(sum(called_inaccurate) FILTER (NOT flagged), 0)::BIGINT AS decoys_called_inaccurate FROM {outcome} GROUP BY 1")
def a29b(t):
    return votes.decoys_called(t.outcome)


@query("a30_consistency", """
SELECT t.task_id, coalesce(n, 0) AS confirmed_statements, CASE WHEN r THEN 'FAIL' WHEN n > 0 THEN 'WARN' ELSE 'PASS' END AS verdict
FROM (SELECT DISTINCT run_id AS task_id FROM {lines_base}) t LEFT JOIN (SELECT task_id, count(*) AS n, bool_or(contains(bears_on, 'criterion')) AS r
  FROM {statements} s JOIN {outcome} o USING (task_id, statement_id) WHERE file = 'ground truth' AND confirmed GROUP BY 1) c ON c.task_id = t.task_id""")
def a30(t):
    held = t.statements.join(t.outcome.select("task_id", "statement_id", "confirmed"), ["task_id", "statement_id"], "left")
    return votes.consistency(held, t.lines_base.select(F.col("run_id").alias("task_id")).distinct())


@query("a40_united_checks", """
SELECT task_id, statement_id, 'criteria check' AS check_name FROM {statements} WHERE flagged AND file = 'ground truth' UNION ALL
SELECT task_id, statement_id, 'justification check' FROM {statements} WHERE flagged AND file = 'prompt'""")
def a40(t):
    first, second = (t.statements.where(F.col("file") == f) for f in ("ground truth", "prompt"))
    return votes.united_checks(first, second).select("task_id", "statement_id", "check_name")


@query("j31_places", """
SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'ground truth' WHEN 1 THEN 'criterion ' || doc_id % 9 WHEN 2 THEN 'test t' || doc_id % 4 WHEN 3 THEN 'answer'
  WHEN 4 THEN 'data/' || source || '.csv' ELSE 'justification' END AS place FROM {documents}""")
def j31(t):
    named = t.documents.selectExpr("doc_id", """CASE doc_id % 6 WHEN 0 THEN ' The  Ground Truth ' WHEN 1 THEN concat('#', doc_id % 9)
      WHEN 2 THEN concat('test t', doc_id % 4) WHEN 3 THEN concat('the run', chr(39), 's answer')
      WHEN 4 THEN concat('`environment/workspace/data/', source, '.csv`') ELSE 'the Justification text' END AS file""")
    return named.select("doc_id", votes.place_of(F.col("file")).alias("place"))


# --- manifests ------------------------------------------------------------------

view("given_files", """
SELECT source AS run_id, CAST(doc_id AS STRING) || '.txt' AS path, CASE WHEN doc_id % 9 = 0 THEN NULL WHEN doc_id % 5 = 0 THEN text || 'x' ELSE text END AS body FROM {documents} WHERE doc_id % 7 <> 0""")
view("finished_files", "SELECT source AS run_id, CAST(doc_id AS STRING) || '.txt' AS path, text AS body, n_chars FROM {documents} WHERE doc_id % 11 <> 0")


def _hashed(df, name="sha256"):
    return df.select("run_id", "path", F.sha2("body", 256).alias(name))


@query("j14_manifest_diff", """
SELECT run_id, path, CASE WHEN g.path IS NULL THEN 'new' WHEN f.path IS NULL THEN 'gone' WHEN g.body IS NULL OR sha256(g.body) = sha256(f.body) THEN 'unchanged' ELSE 'changed' END AS state
FROM {given_files} g FULL JOIN {finished_files} f USING (run_id, path)""")
def j14(t):
    return manifests.diff(_hashed(t.given_files), _hashed(t.finished_files))


@query("j15_manifest_scan", """
SELECT g.run_id, g.path, CASE WHEN f.path IS NULL THEN 'missing' ELSE 'modified' END AS state, CASE WHEN suffix(g.path, '5.txt') THEN 'blocking' ELSE 'recorded' END AS tier
FROM {given_files} g LEFT JOIN {finished_files} f ON f.run_id = g.run_id AND f.path = g.path WHERE g.body IS NOT NULL AND g.body IS DISTINCT FROM f.body""")
def j15(t):
    blocking = t.given_files.where(F.col("path").endswith("5.txt")).select("path")
    return manifests.scan(_hashed(t.given_files.where("body IS NOT NULL")), _hashed(t.finished_files), blocking)


@query("j16_digest_drift", """
SELECT f.run_id, f.path AS key FROM {finished_files} f LEFT JOIN {given_files} g ON g.run_id = f.run_id AND g.path = f.path
WHERE g.path IS NULL OR g.body IS DISTINCT FROM f.body""")
def j16(t):
    keyed = lambda df: _hashed(df).withColumnRenamed("path", "key")
    return manifests.drift(keyed(t.given_files), keyed(t.finished_files))


@query("w07_snapshot_budget", """
WITH RECURSIVE o AS (SELECT run_id, path, n_chars AS bytes, row_number() OVER (PARTITION BY run_id ORDER BY encode(path)) AS rn FROM {finished_files}),
g AS (SELECT run_id, path, bytes, rn, CASE WHEN bytes > 12000 THEN 'over_file_cap' ELSE 'kept' END AS state, CASE WHEN bytes > 12000 THEN 0 ELSE bytes END AS total FROM o WHERE rn = 1
  UNION ALL SELECT o.run_id, o.path, o.bytes, o.rn, CASE WHEN o.bytes > 12000 THEN 'over_file_cap' WHEN g.total + o.bytes > 60000 THEN 'over_total' ELSE 'kept' END,
    CASE WHEN o.bytes > 12000 OR g.total + o.bytes > 60000 THEN g.total ELSE g.total + o.bytes END FROM g JOIN o ON o.run_id = g.run_id AND o.rn = g.rn + 1)
SELECT run_id, path, bytes, state FROM g""")
def w07(t):
    files = t.finished_files.select("run_id", "path", F.col("n_chars").alias("bytes"))
    return manifests.snapshot(files, 12_000, 60_000)


@query("w08_shown_outputs", """
SELECT *, n_chars > shown_chars AS cut FROM (SELECT run_id, path, state, n_chars, least(n_chars, greatest(0, 30000 - coalesce(sum(n_chars) OVER (
  PARTITION BY run_id ORDER BY state <> 'new', path ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)))::BIGINT AS shown_chars
FROM (SELECT source AS run_id, CAST(doc_id AS STRING) || '.txt' AS path, n_chars, CASE WHEN doc_id % 3 = 0 THEN 'new' ELSE 'changed' END AS state FROM {documents}))""")
def w08(t):
    files = t.documents.select(F.col("source").alias("run_id"), F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"),
                               "n_chars", F.when(F.col("doc_id") % 3 == 0, "new").otherwise("changed").alias("state"))
    return materials.shown_outputs(files).select("run_id", "path", "state", "n_chars", "shown_chars", "cut")


# --- materials ------------------------------------------------------------------

view("task_files", """
SELECT run_id AS task_id, 'data/' || lang || '/f' || CAST(j AS STRING) || CASE j % 9 WHEN 0 THEN '.csv' WHEN 1 THEN '.TXT' WHEN 2 THEN '.xlsx' WHEN 3 THEN '.vcf' WHEN 4 THEN '.weird'
  WHEN 5 THEN '_ground_truth.md' WHEN 6 THEN '.pdf' WHEN 7 THEN '' ELSE '.parquet' END AS path, n_chars * 3 AS bytes, n_chars * 4 AS n_chars, j % 4 = 0 AS required FROM {lines_base}""")


@query("a25_material_estimate", """
SELECT task_id, sum(tk)::BIGINT AS material_tokens, coalesce(sum(tk) FILTER (required), 0)::BIGINT AS required_tokens, bool_or(required) AS has_required
FROM (SELECT *, CASE WHEN regexp_matches(path, '\\.(csv|xlsx|parquet)$') THEN least(2000, greatest(1, n_chars // 4)) ELSE greatest(1, n_chars // 4) END AS tk FROM {task_files}) GROUP BY 1""")
def a25(t):
    return materials.material_estimate(t.task_files)


@query("a26_workspace_size", """
SELECT task_id, sum(bytes)::BIGINT AS total_bytes, count(*) AS files, string_agg(path, ', ' ORDER BY rn) FILTER (rn <= 3) AS largest, sum(bytes) > 500000000 AS heavy
FROM (SELECT *, row_number() OVER (PARTITION BY task_id ORDER BY bytes DESC, path DESC) AS rn FROM {task_files}) GROUP BY 1""")
def a26(t):
    return materials.workspace_size(t.task_files)


@query("f19_answer_named_files", "SELECT task_id, path FROM {task_files} WHERE path LIKE '%ground_truth%'")
def f19(t):
    return materials.answer_named_files(t.task_files)


view("task_prompts", """
SELECT run_id AS task_id, CASE WHEN min(doc_id) % 4 = 0 THEN 'Sum it.' WHEN min(doc_id) % 4 = 1 THEN 'Please look at data/en/f0.csv and data/fr/f1.TXT, then tell me in plain words what the totals of the site are.'
  WHEN min(doc_id) % 4 = 2 THEN 'Could you go over it.' || chr(10) || '  1) sum the tables' || chr(10) || '  2) tell me which of the sites grew and by how much overall' ELSE '' END AS prompt
FROM {lines_base} GROUP BY run_id""")


@query("f20_prompt_shape", """
SELECT p.task_id, prompt = '' AS empty, len(prompt) BETWEEN 1 AND 79 AS very_short, contains(prompt, '1) ') AS reads_like_specification,
  (SELECT count(DISTINCT path) FROM {task_files} f WHERE f.task_id = p.task_id AND regexp_matches(path, '[.]') AND contains(p.prompt, f.path)) AS files_named FROM {task_prompts} p""")
def f20(t):
    return materials.prompt_shape(t.task_prompts, t.task_files)


@query("f21_suffix_findings", """
SELECT DISTINCT task_id, suffix, CASE suffix WHEN '.weird' THEN 'not recognised' ELSE 'needs a package' END AS problem,
  CASE suffix WHEN '.vcf' THEN 'pysam' WHEN '.pdf' THEN 'pdfplumber' WHEN '.parquet' THEN 'pyarrow' END AS package
FROM (SELECT task_id, lower(regexp_extract(path, '(\\.[^./]+)$', 1)) AS suffix, right(task_id, 1) AS d FROM {task_files})
WHERE suffix IN ('.weird', '.vcf', '.pdf') OR (suffix = '.parquet' AND d <> '0')""")
def f21(t):
    present = t.task_files.where(F.col("task_id").endswith("0")).select("task_id").distinct().withColumn("spec", F.lit("PyArrow==15"))
    return materials.suffix_findings(t.task_files, present)


@query("j29_accounts_differ", """
SELECT f.task_id, path, CASE WHEN required THEN 'required_called_misleading' ELSE 'distractor_not_mentioned' END AS side
FROM {task_files} f JOIN (SELECT run_id AS task_id, 'Beware of F' || (min(doc_id) % 5) || '.CSV and data/en/f' || (min(doc_id) % 9) || '.weird' AS prose FROM {lines_base} GROUP BY 1) p USING (task_id)
WHERE required = (contains(lower(prose), lower(regexp_extract(path, '[^/]*$'))))""")
def j29(t):
    prose = t.lines_base.groupBy(F.col("run_id").alias("task_id")).agg(F.min("doc_id").alias("d")).select(
        "task_id", F.concat(F.lit("Beware of F"), F.col("d") % 5, F.lit(".CSV and data/en/f"), F.col("d") % 9, F.lit(".weird")).alias("text"))
    return materials.accounts_differ(t.task_files, prose)


@query("j27_paths_nobody_has", """
SELECT DISTINCT task_id, p AS path FROM (SELECT task_id, unnest(['f0.csv', 'en/f9.csv', 'made/up_' || (len(path) % 3) || '.json', 'fr/f1.TXT']) AS p FROM {task_files}) a
WHERE NOT EXISTS (SELECT 1 FROM {task_files} f WHERE f.task_id = a.task_id AND (f.path = p OR suffix(f.path, '/' || p)))
  AND NOT EXISTS (SELECT 1 FROM {task_prompts} q WHERE q.task_id = a.task_id AND contains(q.prompt, p))""")
def j27(t):
    tests = t.task_files.select("task_id", F.concat(
        F.lit("def test_a():\n  open('./f0.csv'); open(\"en/f9.csv\"); x = 'made/up_"), F.length("path") % 3,
        F.lit(".json'\n  assert read('fr/f1.TXT') == 'two words.txt'")).alias("source"))
    return materials.paths_nobody_has(tests, t.task_files, t.task_prompts)


@query("s07_latest_attempt", """
SELECT user_id AS job, arg_max(attempt, (ts, path)) AS attempt, count(DISTINCT attempt) AS attempts FROM (
  SELECT user_id, event_type AS attempt, ts, 'p' || event_id AS path FROM {events}) GROUP BY 1""")
def s07(t):
    rows = t.events.select(F.col("user_id").alias("job"), F.col("event_type").alias("attempt"), F.col("ts").alias("modified"),
                           F.concat(F.lit("p"), F.col("event_id").cast("string")).alias("path"))
    return materials.latest_attempt(rows)


@query("s09_file_listing", "SELECT task_id, count(*) AS files FROM {task_files} GROUP BY 1")
def s09(t):
    hidden = t.task_files.select("task_id").distinct().withColumn("path", F.lit("a/" + fixed.PLACEHOLDER_FILE))
    return materials.listing(t.task_files.select("task_id", "path").unionByName(hidden)).groupBy("task_id").agg(F.count("*").alias("files"))


# --- text sources held in columns -----------------------------------------------

@query("s01_csv_rows", """
SELECT event_id, event_type AS zone, value AS price_usd_mwh, CAST(user_id AS INT) AS hour FROM {events}""")
def s01(t):
    line = F.concat_ws(",", F.col("event_id").cast("string"), "event_type", F.col("value").cast("string"), F.col("user_id").cast("string"))
    parsed = readers.csv_rows(line, "event_id BIGINT, zone STRING, price_usd_mwh DOUBLE, hour INT")
    return t.events.select(parsed.alias("r")).select("r.*")


@query("s04_graded_rows_both_shapes", """
SELECT doc_id, 'line ' || n_chars AS title, CAST(n_chars % 5 AS INT) AS weight, CAST(n_chars % 2 AS VARCHAR) AS score, text AS justification FROM {documents}""")
def s04(t):
    row = F.to_json(F.struct(F.concat(F.lit("line "), F.col("n_chars").cast("string")).alias("title"), (F.col("n_chars") % 5).alias("weight"),
                             F.struct((F.col("n_chars") % 2).cast("string").alias("score"), F.col("text").alias("justification")).alias("score")))
    document = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("["), row, F.lit("]"))).otherwise(
        F.concat(F.lit('{"rubric_scores": ['), row, F.lit('], "overall": {}}')))
    return readers.graded_rows(t.documents.select("doc_id", document.alias("document"))).select(
        "doc_id", "title", "weight", F.col("score.score").alias("score"), F.col("score.justification").alias("justification"))


@query("j14_manifest_maps", "SELECT doc_id, 'a/' || lang || '.csv' AS path, md5(text) AS sha256 FROM {documents}")
def j14b(t):
    body = F.to_json(F.create_map(F.concat(F.lit("a/"), "lang", F.lit(".csv")), F.md5("text")))
    held = F.when(F.col("doc_id") % 2 == 0, body).otherwise(F.concat(F.lit('{"schema_version": 1, "files": '), body, F.lit("}")))
    return manifests.exploded(t.documents.select("doc_id", held.alias("manifest")))
