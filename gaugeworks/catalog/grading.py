"""Queries over graded runs, derived from `documents`, `labels` and `events`."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugeworks.catalog.base import Inputs, built, query, view
from gaugeworks.operators import grading, whatif

# A run is forty documents of one source; a line's place in its source picks its weight.
view("lines_base", """
SELECT d.*, CAST(FLOOR(d.doc_id / 20.0) AS BIGINT) AS j, d.doc_id % 20 AS k,
  d.source || '-' || CAST(CAST(FLOOR(d.doc_id / 800.0) AS BIGINT) AS STRING) AS run_id,
  l.quality, l.toxic
FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id""")

view("judged_input", """
SELECT run_id, doc_id AS line_no,
  CASE WHEN j % 9 = 0 THEN '3.' || CAST(j % 4 AS STRING) || ': ' ELSE '' END
    || 'Response states ' || CAST(n_chars % 60 AS STRING) || ' rows in file_'
    || CAST(j % 7 AS STRING) || '.csv' AS title,
  CASE WHEN doc_id % 31 = 0 THEN NULL ELSE CAST(CASE (j + k) % 6 WHEN 0 THEN 5 WHEN 1 THEN 3
    WHEN 2 THEN 1 WHEN 3 THEN -1 WHEN 4 THEN -3 ELSE -5 END AS INT) END AS weight,
  CASE WHEN (j + k) % 6 >= 3 THEN CASE WHEN j % 8 = 3 THEN 'clarification' ELSE 'hallucination' END
    WHEN j % 10 = 0 THEN NULL WHEN j % 5 = 1 THEN 'clarification' ELSE 'task completion' END AS label,
  CASE WHEN doc_id % 4 = 0 THEN NULL WHEN mark = 1 THEN CASE WHEN j % 2 = 0 THEN ' yes ' ELSE 'TRUE' END
    WHEN mark = 0 THEN CASE WHEN j % 3 = 0 THEN 'No' ELSE 'n' END ELSE 'maybe' END AS status,
  CASE WHEN doc_id % 4 = 1 THEN NULL WHEN mark = 1 THEN CASE WHEN doc_id % 17 = 0 THEN '0' ELSE '1.0' END
    WHEN mark = 0 THEN CASE WHEN j % 2 = 0 THEN '0' ELSE 'false' END ELSE 'n/a' END AS score,
  coalesce(toxic = 1, FALSE) AND doc_id % 3 = 0 AS refused,
  text AS justification
FROM (SELECT *, CASE WHEN quality IS NOT NULL THEN quality WHEN n_chars % 11 = 0 THEN NULL
  ELSE n_chars % 2 END AS mark FROM {lines_base}) marked""")

view("unit_input", """
SELECT run_id, 'test_' || CAST(j AS STRING) AS name,
  CASE n_chars % 4 WHEN 0 THEN 'passed' WHEN 1 THEN 'failed' WHEN 2 THEN 'passed' ELSE 'skipped' END AS status,
  CASE n_chars % 3 WHEN 0 THEN 'AssertionError: ' WHEN 1 THEN '  assert x' ELSE 'KeyError: ' END || text AS message,
  CASE WHEN j % 4 = 0 THEN NULL ELSE CAST(CASE j % 3 WHEN 0 THEN 5 WHEN 1 THEN 3 ELSE 1 END AS INT) END AS weight
FROM {lines_base} WHERE n_chars % 2 = 0 OR n_chars % 3 = 0""")

view("run_states", """
SELECT run_id, CASE CAST(min(n_chars) AS BIGINT) % 5 WHEN 0 THEN 'unreachable' WHEN 1 THEN 'error' ELSE 'graded' END
  AS judge_state, CASE CAST(max(n_chars) AS BIGINT) % 4 WHEN 0 THEN 'skipped' WHEN 1 THEN 'error' ELSE 'ran' END AS unit_state
FROM {lines_base} GROUP BY run_id""")

_STATUS = "CASE WHEN upper(trim(status)) IN ('YES','Y','TRUE','1') THEN 'YES' WHEN upper(trim(status)) IN ('NO','N','FALSE','0') THEN 'NO' END"
_SCORE = "CASE WHEN trim(score) IN ('1','1.0') OR lower(trim(score)) IN ('yes','true') THEN '1' WHEN trim(score) IN ('0','0.0') OR lower(trim(score)) IN ('no','false') THEN '0' END"


@built("judged", f"""
SELECT *, CASE WHEN score NOT IN ('0','1') OR score IS NULL THEN 'UNSCORED'
    WHEN (score = '1') <> (weight < 0) THEN 'PASS' ELSE 'FAIL' END AS verdict,
  CASE label WHEN 'task completion' THEN 'completion' WHEN 'clarification' THEN 'clarification'
    WHEN 'hallucination' THEN 'non-hallucination' ELSE CASE WHEN weight < 0 THEN 'non-hallucination'
    ELSE 'completion' END END AS kind,
  CASE WHEN refused THEN 'judge_refused' WHEN score IS NULL THEN 'judge_no_score' END AS unmeasured
FROM (SELECT run_id, line_no, title, coalesce(weight, 5) AS weight, label, refused, justification,
  canon_status AS status, CASE WHEN refused THEN NULL ELSE chosen END AS score,
  coalesce(st <> sc, FALSE) AS status_score_mismatch
FROM (SELECT *, CASE chosen WHEN '1' THEN 'YES' WHEN '0' THEN 'NO' ELSE ns END AS canon_status FROM (
  SELECT *, coalesce(st, sc) AS chosen FROM (
  SELECT *, CASE ns WHEN 'YES' THEN '1' WHEN 'NO' THEN '0' END AS st FROM (
  SELECT *, {_STATUS} AS ns, {_SCORE} AS sc FROM {{judged_input}})))))""")
def judged(t: Inputs):
    return grading.graded(t.judged_input.withColumn("type", F.array_compact(F.array("label"))))


@built("units", "SELECT * EXCLUDE (weight), coalesce(weight, 3) AS weight FROM {unit_input}")
def units(t: Inputs):
    return grading.with_test_weights(t.unit_input)


_SUMS = """count(*) AS total, count(*) FILTER (verdict <> 'UNSCORED') AS scored,
  count(*) FILTER (verdict = 'UNSCORED') AS unscored,
  count(*) FILTER (unmeasured = 'judge_refused') AS refused,
  round(coalesce(sum(abs(weight)) FILTER (verdict = 'UNSCORED'), 0)::DOUBLE / sum(abs(weight)), 4) AS coverage_lost,
  count(*) FILTER (verdict = 'PASS') AS passed,
  coalesce(sum(weight) FILTER (verdict <> 'UNSCORED' AND weight > 0), 0)::BIGINT AS max_reward,
  coalesce(sum(weight) FILTER (verdict = 'PASS' AND weight > 0), 0)::BIGINT AS earned,
  coalesce(-sum(weight) FILTER (verdict = 'FAIL' AND weight < 0), 0)::BIGINT AS lost"""


@built("scores", f"""
SELECT *, earned - lost AS agent_score,
  greatest(0.0::DOUBLE, coalesce((earned - lost)::DOUBLE / nullif(max_reward, 0), 0)) AS rate,
  coalesce(passed::DOUBLE / nullif(scored, 0), 0) AS count_rate
FROM (SELECT run_id, {_SUMS} FROM {{judged}} GROUP BY run_id)""")
def scores(t: Inputs):
    return grading.run_scores(t.judged)


@built("points", """
SELECT run_id, count(*) AS unit_total, count(*) FILTER (status = 'passed') AS unit_passed,
  coalesce(sum(weight) FILTER (status = 'passed'), 0)::BIGINT AS unit_score, sum(weight)::BIGINT AS unit_max
FROM {units} GROUP BY run_id""")
def points(t: Inputs):
    return grading.unit_points(t.units)


@built("rewards", """
SELECT run_id, CASE WHEN judge_state = 'graded' THEN round(rate, 4) ELSE 0.0::DOUBLE END AS rubrics,
  CASE unit_state WHEN 'ran' THEN round(coalesce(unit_score::DOUBLE / nullif(unit_max, 0), 0), 4)
    WHEN 'error' THEN 0.0::DOUBLE END AS unit_tests,
  CASE WHEN unit_state = 'error' THEN 0.0::DOUBLE WHEN judge_state = 'graded' AND unit_state = 'ran' THEN
    round(greatest(0.0::DOUBLE, coalesce((agent_score + coalesce(unit_score, 0))::DOUBLE
      / nullif(max_reward + coalesce(unit_max, 0), 0), 0)), 4)
    WHEN judge_state = 'graded' THEN round(rate, 4) ELSE 0.0::DOUBLE END AS reward,
  CASE WHEN unit_state = 'error' OR judge_state = 'unreachable' THEN 'error' WHEN judge_state = 'error' THEN 'incomplete'
    ELSE 'graded' END AS status,
  CASE WHEN judge_state = 'graded' AND unit_state = 'ran' THEN agent_score + coalesce(unit_score, 0) END AS combined_score,
  CASE WHEN judge_state = 'graded' AND unit_state = 'ran' THEN max_reward + coalesce(unit_max, 0) END AS combined_of
FROM {run_states} LEFT JOIN {scores} USING (run_id) LEFT JOIN {points} USING (run_id)""")
def rewards(t: Inputs):
    return grading.combined_reward(t.scores, t.points, t.run_states)


@query("f10_verdict_canonical", "SELECT line_no, status, score, status_score_mismatch FROM {judged}")
def f10(t):
    return t.judged.select("line_no", "status", "score", "status_score_mismatch")


@query("f11_signed_verdict", "SELECT line_no, weight, verdict FROM {judged}")
def f11(t):
    return t.judged.select("line_no", "weight", "verdict")


@query("f12_criterion_kind", "SELECT line_no, kind FROM {judged}")
def f12(t):
    return t.judged.select("line_no", "kind")


@query("f13_unmeasured_reason", "SELECT line_no, unmeasured FROM {judged} WHERE unmeasured IS NOT NULL")
def f13(t):
    return t.judged.where("unmeasured IS NOT NULL").select("line_no", "unmeasured")


@query("f27_assertion_or_crash", """
SELECT run_id, name, NOT (starts_with(trim(split_part(trim(message), chr(10), 1)), 'AssertionError')
  OR starts_with(trim(split_part(trim(message), chr(10), 1)), 'assert')) AS crash
FROM {units} WHERE status = 'failed'""")
def f27(t):
    return t.units.where("status = 'failed'").select(
        "run_id", "name", grading.is_crash(F.col("message")).alias("crash"))


@query("a16_run_score", "SELECT * REPLACE (round(rate, 6) AS rate, round(count_rate, 6) AS count_rate) FROM {scores}")
def a16(t):
    return t.scores.withColumn("rate", F.round("rate", 6)).withColumn(
        "count_rate", F.round("count_rate", 6))


@query("a17_unit_points", "SELECT * FROM {points}")
def a17(t):
    return t.points


@query("a18_combined_reward", "SELECT * FROM {rewards}")
def a18(t):
    return t.rewards


@built("report", """
SELECT run_id, title AS name, CASE verdict WHEN 'PASS' THEN 'passed' WHEN 'FAIL' THEN 'failed' ELSE 'other' END AS status,
  substr(coalesce(justification, ''), 1, 2000) AS message FROM {judged} UNION ALL
SELECT run_id, name || ' [' || weight || ']', CASE WHEN status = 'passed' THEN 'passed' ELSE 'failed' END,
  substr(coalesce(message, ''), 1, 2000) FROM {units}""")
def report(t: Inputs):
    return grading.report_rows(t.judged, t.units)


@query("s14_flat_report", "SELECT run_id, name, status, md5(message) AS message_md5 FROM {report}")
def s14(t):
    return t.report.select("run_id", "name", "status", F.md5("message").alias("message_md5"))


@query("a19_report_counts", """
SELECT run_id, count(*) AS tests, count(*) FILTER (status = 'passed') AS passed,
  count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'other') AS other
FROM {report} GROUP BY run_id""")
def a19(t):
    return grading.report_counts(t.report)


_KINDS = """
SELECT run_id, count(*) FILTER (label = 'task completion') AS completion,
  count(*) FILTER (label = 'clarification') AS clarification,
  count(*) FILTER (label = 'hallucination') AS non_hallucination,
  count(*) FILTER (label IS NULL) AS unlabelled,
  count(*) FILTER (weight < 0 AND coalesce(label, 'hallucination') = 'hallucination') AS negatives,
  count(*) FILTER (label = 'clarification' AND weight > 0) AS clarification_positive,
  count(*) FILTER (label = 'clarification') AS clarification_total
FROM {judged} GROUP BY run_id"""


@query("a20_kind_counts", _KINDS)
def a20(t):
    return grading.kind_counts(t.judged)


@query("a21_duplicate_criteria", """
SELECT run_id, md5(title) AS criterion_id, count(*) AS copies, min(line_no) AS first_line
FROM {judged} GROUP BY ALL HAVING count(*) > 1""")
def a21(t):
    return grading.duplicate_lines(t.judged)


@query("x19_criterion_ids", r"""
SELECT line_no, md5(trim(regexp_replace(title, '^\d+(\.\d+)*:\s*', ''))) AS criterion_id,
  sha256(title) AS title_sha256 FROM {judged}""")
def x19(t):
    return t.judged.select("line_no", grading.criterion_id(F.col("title")).alias("criterion_id"),
                           F.sha2("title", 256).alias("title_sha256"))


@query("a39_coverage_over_limit", "SELECT run_id, coverage_lost, unscored, refused FROM {scores} WHERE coverage_lost >= 0.10")
def a39(t):
    return grading.coverage_over_limit(t.scores)


_FIRED = """
SELECT run_id, count(*) AS negatives, count(*) FILTER (verdict = 'FAIL') AS fired,
  count(*) FILTER (verdict = 'PASS') AS quiet, count(*) FILTER (verdict = 'PASS') > 2 AS over_quiet_cap
FROM {judged} WHERE weight < 0 AND kind = 'non-hallucination' AND verdict <> 'UNSCORED' GROUP BY run_id"""


@query("a42_fired_and_quiet", _FIRED)
def a42(t):
    return grading.fired_counts(t.judged)


@query("u04_fired_negatives", """
SELECT line_no, verdict = 'FAIL' AS fired FROM {judged}
WHERE weight < 0 AND kind = 'non-hallucination' AND verdict <> 'UNSCORED'""")
def u04(t):
    return grading.fired_negatives(t.judged).select("line_no", "fired")


@query("t12_negatives_fired", """
SELECT line_no, title, score = '1' AS fired FROM {judged} WHERE weight < 0 AND score IN ('0', '1')""")
def t12(t):
    return t.judged.where((F.col("weight") < 0) & F.col("score").isin("0", "1")).select(
        "line_no", "title", (F.col("score") == "1").alias("fired"))


@query("u05_without_refused", """
SELECT line_no, title FROM {judged} j WHERE NOT EXISTS (SELECT 1 FROM {judged} r
  WHERE r.refused AND r.run_id = j.run_id AND trim(r.title) = trim(j.title))""")
def u05(t):
    return grading.without_dropped(t.judged, t.judged.where("refused")).select("line_no", "title")


view("shipped_lines", """
SELECT run_id, line_no, CASE WHEN line_no % 23 = 0 THEN title || ' exactly' ELSE title END AS title
FROM {judged_input} WHERE line_no % 29 <> 0""")


@query("j28_graded_vs_shipped", """
SELECT run_id, text, CASE WHEN g IS NULL THEN 'only_shipped' ELSE 'only_graded' END AS side
FROM (SELECT DISTINCT run_id, trim(title) AS text, 1 AS g FROM {judged})
FULL JOIN (SELECT DISTINCT run_id, trim(title) AS text, 1 AS s FROM {shipped_lines}) USING (run_id, text)
WHERE g IS NULL OR s IS NULL""")
def j28(t):
    return grading.graded_against_shipped(t.judged, t.shipped_lines)


view("confirmed_lines", """
SELECT run_id, title, CASE WHEN line_no % 3 = 0 THEN 'PASS' ELSE 'FAIL' END AS verdict,
  line_no % 4 <> 0 AS confirmed FROM {judged_input}""")


@query("j17_carried_confirmations", """
SELECT line_no, title, verdict FROM {judged} j WHERE EXISTS (SELECT 1 FROM {confirmed_lines} c
  WHERE c.confirmed AND c.run_id = j.run_id AND c.title = j.title AND c.verdict = j.verdict)""")
def j17(t):
    return grading.carried_over(t.confirmed_lines, t.judged).select("line_no", "title", "verdict")


view("recorded_weights", """
SELECT DISTINCT run_id, name, CAST(5 AS INT) AS weight FROM {unit_input} WHERE weight IS NULL AND length(name) % 2 = 0""")


@query("j26_test_weights", """
SELECT u.run_id, u.name, coalesce(w.weight, 3) AS weight FROM {unit_input} u
LEFT JOIN {recorded_weights} w ON u.run_id = w.run_id AND u.name = w.name""")
def j26(t):
    return grading.with_test_weights(t.unit_input, t.recorded_weights).select(
        "run_id", "name", "weight")


@query("s17_unit_rows_recovered", """
WITH own AS (SELECT run_id, name, status FROM {unit_input} WHERE name LIKE '%1')
SELECT run_id, name, status, 'results' AS origin FROM own UNION ALL
SELECT run_id, name, status, 'report' FROM {report} r WHERE r.run_id NOT IN (SELECT run_id FROM own)
  AND name <> 'rubrics' AND NOT EXISTS (SELECT 1 FROM {judged} j WHERE j.run_id = r.run_id AND trim(j.title) = trim(r.name))""")
def s17(t):
    return grading.unit_rows_or_recovered(
        t.unit_input.where(F.col("name").endswith("1")), t.report, t.judged)


@query("h01_sensitivity", """
SELECT run_id, line_no, trim(title) AS criterion, weight,
  round(greatest(0, s + abs(weight))::DOUBLE / of, 4) AS reward_if_reversed
FROM (SELECT run_id, CASE WHEN combined_of > 0 THEN combined_score ELSE earned - lost END AS s,
    CASE WHEN combined_of > 0 THEN combined_of ELSE max_reward END AS of FROM {scores} LEFT JOIN {rewards} USING (run_id))
JOIN {judged} USING (run_id)
WHERE of > 0 AND verdict = 'FAIL' AND greatest(0, s + abs(weight))::DOUBLE / of >= 0.5""")
def h01(t):
    combined = t.rewards.select("run_id", F.col("combined_score").alias("score"),
                                F.col("combined_of").alias("of"))
    return whatif.sensitivity(t.judged, combined)


@query("k02_flips_sorted", """
SELECT run_id, line_no, round(greatest(0, earned - lost + abs(weight))::DOUBLE / max_reward, 4) AS reward_if_reversed
FROM {scores} JOIN {judged} USING (run_id) WHERE max_reward > 0 AND verdict = 'FAIL'
  AND greatest(0, earned - lost + abs(weight))::DOUBLE / max_reward >= 0.5 ORDER BY 3 DESC, 1, 2""")
def k02(t):
    return whatif.flips_in_order(whatif.sensitivity(t.judged)).select(
        "run_id", "line_no", "reward_if_reversed")


view("new_weights", "SELECT run_id, title, CAST(1 AS INT) AS weight FROM {judged_input} WHERE line_no % 37 = 5")
view("dropped_lines", "SELECT run_id, title FROM {judged_input} WHERE line_no % 41 = 7")


@query("h02_reweight_and_drop", r"""
WITH k AS (SELECT *, trim(regexp_replace(title, '\s+', ' ', 'g')) AS txt FROM {judged}),
c AS (SELECT k.* EXCLUDE (weight), coalesce(n.weight, k.weight) AS weight FROM k
  LEFT JOIN (SELECT DISTINCT run_id, trim(regexp_replace(title, '\s+', ' ', 'g')) AS txt, weight FROM {new_weights}) n
    ON n.run_id = k.run_id AND n.txt = k.txt
  WHERE NOT EXISTS (SELECT 1 FROM {dropped_lines} d WHERE d.run_id = k.run_id
    AND trim(regexp_replace(d.title, '\s+', ' ', 'g')) = k.txt)),
a AS (SELECT run_id, coalesce(sum(CASE WHEN weight > 0 AND verdict = 'PASS' THEN weight
    WHEN weight < 0 AND verdict = 'FAIL' THEN weight END), 0) AS e,
  coalesce(sum(weight) FILTER (weight > 0 AND verdict <> 'UNSCORED'), 0) AS o FROM c GROUP BY run_id),
f AS (SELECT s.run_id, coalesce(e, 0) + coalesce(combined_score - (earned - lost), 0) AS e,
    coalesce(o, 0) + coalesce(combined_of - max_reward, 0) AS o
  FROM {scores} s LEFT JOIN a USING (run_id) LEFT JOIN {rewards} USING (run_id))
SELECT run_id, CASE WHEN o > 0 THEN round(greatest(0, e)::DOUBLE / o, 4) END AS reward FROM f""")
def h02(t):
    combined = t.rewards.select("run_id", F.col("combined_score").alias("score"),
                                F.col("combined_of").alias("of"))
    return whatif.with_fixes(t.judged, t.new_weights, t.dropped_lines, combined)


view("grade_history", """
SELECT user_id AS job, event_id AS grade_id, ts AS at, CAST((CAST(FLOOR(value) AS BIGINT) * 7 + event_id) % 100 AS DOUBLE) / 100 AS reward
FROM {events}""")
view("grade_lines", """
SELECT job, grade_id, 'line a' AS text, CAST(CASE WHEN grade_id % 3 = 0 THEN 5 ELSE 3 END AS INT) AS weight FROM {grade_history}
UNION ALL SELECT job, grade_id, 'line b', CAST(-1 AS INT) FROM {grade_history} WHERE grade_id % 2 = 0
UNION ALL SELECT job, grade_id, 'line c', CAST(CASE WHEN grade_id % 5 = 0 THEN 1 ELSE 3 END AS INT) FROM {grade_history}""")
view("weight_findings", """
SELECT DISTINCT job, 'line a' AS text, CAST(3 AS INT) AS proposed_weight FROM {grade_history} WHERE job % 3 = 0""")


@query("h03_weights_only_drop", """
WITH ids AS (SELECT job, grade_id, string_agg(DISTINCT text, '|' ORDER BY text) AS lines FROM {grade_lines} GROUP BY ALL),
g AS (SELECT * FROM {grade_history} JOIN ids USING (job, grade_id)),
m AS (SELECT l.job, l.grade_id, h.grade_id AS earlier_id, h.at AS hat, a.text, b.weight AS before, a.weight AS after
  FROM g l JOIN g h ON l.job = h.job AND l.lines = h.lines AND (h.at, h.grade_id) < (l.at, l.grade_id)
    AND l.reward < 0.5 AND h.reward >= 0.5
  JOIN {grade_lines} a ON a.job = l.job AND a.grade_id = l.grade_id
  JOIN {grade_lines} b ON b.job = h.job AND b.grade_id = h.grade_id AND b.text = a.text
  LEFT JOIN {weight_findings} p ON p.job = a.job AND p.text = a.text AND p.proposed_weight = a.weight
  WHERE a.weight <> b.weight AND p.job IS NULL)
SELECT job, grade_id, earlier_id, text, before, after FROM m
QUALIFY rank() OVER (PARTITION BY job, grade_id ORDER BY hat DESC, earlier_id DESC) = 1""")
def h03(t):
    proposed = t.weight_findings.groupBy("job", "text").agg(
        F.collect_set("proposed_weight").alias("weights"))
    return whatif.weights_only_drops(t.grade_history, t.grade_lines, proposed, max_rows=4_000)


@query("j24_previous_grade", """
SELECT job, grade_id, reward, lag("at") OVER (PARTITION BY job ORDER BY "at", grade_id) AS earlier_at,
  lag(reward) OVER (PARTITION BY job ORDER BY "at", grade_id) AS earlier_reward FROM {grade_history}""")
def j24(t):
    return whatif.latest_earlier(t.grade_history).select(
        "job", "grade_id", "reward", "earlier_at", "earlier_reward")


@query("h04_difficulty_filter", "SELECT run_id, reward FROM {rewards} WHERE reward < 0.5")
def h04(t):
    return whatif.below_bar(t.rewards).select("run_id", "reward")


@query("a36_proposed_weights", """
SELECT run_id, title AS text, string_agg(DISTINCT CAST(weight AS VARCHAR), ',' ORDER BY CAST(weight AS VARCHAR)) AS weights
FROM {judged_input} WHERE weight IS NOT NULL GROUP BY ALL""")
def a36(t):
    named = grading.proposed_weights(t.judged_input.withColumn("proposed_weight", F.col("weight")))
    return named.select("run_id", "text", F.array_join(F.array_sort(F.transform(
        "weights", lambda w: w.cast("string"))), ",").alias("weights"))


@query("f28_delivery_gates", f"""
SELECT *, gate_all_judged AND gate_coverage AND gate_negatives AND gate_quiet AND gate_context AND gate_reward AS deliverable
FROM (SELECT run_id, unscored - refused = 0 AS gate_all_judged, coverage_lost < 0.10 AS gate_coverage,
  coalesce(k.negatives, 0) >= 5 AS gate_negatives, coalesce(quiet, 0) <= 2 AS gate_quiet,
  context_added >= 27000 AS gate_context, coalesce(reward, 1.0) < 0.5 AS gate_reward
FROM {{scores}} LEFT JOIN ({_KINDS}) k USING (run_id) LEFT JOIN ({_FIRED}) f USING (run_id)
LEFT JOIN (SELECT run_id, CASE WHEN count(*) % 7 <> 0 THEN (max(n_chars) - min(n_chars)) * 4 END AS context_added
  FROM {{lines_base}} GROUP BY run_id) USING (run_id) LEFT JOIN {{rewards}} USING (run_id))""")
def f28(t):
    context = t.lines_base.groupBy("run_id").agg(F.when(
        F.count("*") % 7 != 0, (F.max("n_chars") - F.min("n_chars")) * 4).alias("context_added"))
    return grading.delivery_gates(t.scores, grading.kind_counts(t.judged),
                                  grading.fired_counts(t.judged).drop("negatives"), context, t.rewards)
