"""Queries over run transcripts built from `conversations`: one conversation, one run.

Even runs are written in one record dialect, odd runs in another; the SQL side
works from the columns and never sees the JSON.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugeworks import fixed
from gaugeworks.catalog import duck
from gaugeworks.catalog.base import Inputs, built, query, view
from gaugeworks.functions import text as tx
from gaugeworks.functions.tokens import token_band
from gaugeworks.operators import packages, provenance, runs, transcripts, web
from gaugeworks.sources import transcripts as src


def _esc(x: str) -> str:
    return (f"replace(replace(replace(replace(replace({x}, chr(92), chr(92) || chr(92)), '\"', chr(92) || '\"'), "
            f"chr(10), chr(92) || 'n'), chr(13), chr(92) || 'r'), chr(9), chr(92) || 't')")


view("turns", """
SELECT conv_id AS run_id, turn, role, text, conv_id % 2 AS dialect, role = 'assistant' AS agent,
  'c' || CAST(conv_id AS STRING) || '-' || CAST(turn AS STRING) AS call_id,
  CASE WHEN (conv_id + turn) % 5 = 0 THEN 'tool_use' WHEN (conv_id + turn) % 5 = 1 THEN 'end_turn'
    WHEN (conv_id + turn) % 5 = 2 THEN 'stop' END AS stop_reason,
  CASE (conv_id * 3 + turn) % 6
    WHEN 0 THEN 'ls data/file_' || CAST(turn AS STRING) || '.csv'
    WHEN 1 THEN 'pip install -q pkg' || CAST(conv_id % 9 AS STRING) || '==1.' || CAST(turn AS STRING)
      || ' lib' || CAST(conv_id % 5 AS STRING) || ' -r reqs.txt && python run.py'
    WHEN 2 THEN 'curl https://www.site' || CAST(conv_id % 13 AS STRING) || '.example.com/q'
    WHEN 3 THEN 'wget https://pypi.org/simple'
    WHEN 4 THEN 'sudo apt-get install tool' || CAST(conv_id % 4 AS STRING) || '; echo done'
    ELSE 'python3 -m pip install --index-url http://mirror.local scipy' END AS command,
  CASE (conv_id * 3 + turn) % 6
    WHEN 2 THEN 'page says ' || CAST(500000 + conv_id * 100 + turn AS STRING) || ' units'
    WHEN 5 THEN 'ModuleNotFoundError: No module named ' || chr(39) || 'pkg' || CAST(conv_id % 9 AS STRING) || '.core' || chr(39)
    WHEN 4 THEN 'E: Unable to locate package tool' || CAST(conv_id % 4 AS STRING)
    ELSE 'total ' || CAST(conv_id * 37 + turn * 11 AS STRING) || ' rows in data/file_' || CAST(turn AS STRING) || '.csv' END AS result
FROM {conversations}""")

view("records_json", f"""
SELECT t.run_id, t.turn, CASE
  WHEN t.dialect = 0 AND t.agent THEN '{{{{"role":"assistant","model":"acme/Alpha-' || CAST(t.run_id % 3 AS STRING)
    || '","stop_reason":' || coalesce('"' || t.stop_reason || '"', 'null') || ',"content":[{{{{"type":"text","text":"' || {_esc('t.text')}
    || '"}}}},{{{{"type":"tool_use","id":"' || t.call_id || '","name":"bash","input":{{{{"command":"' || {_esc('t.command')}
    || '","description":"step ' || CAST(t.turn AS STRING) || '"}}}}}}}}]}}}}'
  WHEN t.dialect = 0 THEN '{{{{"role":"' || t.role || '","content":[' || coalesce('{{{{"type":"tool_result","tool_use_id":"' || p.call_id
    || '","content":[{{{{"type":"text","text":"' || {_esc('p.result')} || '"}}}}]}}}},', '') || '{{{{"type":"text","text":"' || {_esc('t.text')} || '"}}}}]}}}}'
  WHEN t.agent THEN '{{{{"source":"agent","model_name":"Alpha-' || CAST(t.run_id % 3 AS STRING) || '","message":"' || {_esc('t.text')}
    || '","extra":{{{{"finish_reason":' || coalesce('"' || t.stop_reason || '"', 'null') || '}}}},"tool_calls":[{{{{"id":"' || t.call_id
    || '","function":{{{{"name":"bash","arguments":"' || {_esc("'{{\"command\":\"' || " + _esc('t.command') + " || '\"}}'")}
    || '"}}}}}}}}],"observation":{{{{"results":[{{{{"source_call_id":"' || t.call_id || '","content":"' || {_esc('t.result')} || '"}}}}]}}}}}}}}'
  ELSE '{{{{"source":"' || t.role || '","message":"' || {_esc('t.text')} || '"}}}}' END AS record
FROM {{turns}} t LEFT JOIN {{turns}} p ON p.run_id = t.run_id AND p.turn = t.turn - 1 AND p.agent""")


@built("records", "SELECT run_id, turn FROM {turns}")
def records(t: Inputs):
    return src.parse_records(t.records_json)


@built("steps", f"SELECT *, {duck.strip('text')} AS said FROM {{turns}}")
def steps(t: Inputs):
    return src.steps(t.records)


@built("calls", "SELECT run_id, turn FROM {turns}")
def calls(t: Inputs):
    return src.tool_calls(t.records)


@built("results", "SELECT run_id, turn FROM {turns}")
def results(t: Inputs):
    return src.tool_results(t.records)


view("result_rows_sql", """
SELECT r.run_id, r.turn + CASE WHEN r.dialect = 0 THEN 1 ELSE 0 END AS turn, r.call_id, r.result AS text
FROM {turns} r WHERE r.agent AND (r.dialect = 1 OR EXISTS (SELECT 1 FROM {turns} n WHERE n.run_id = r.run_id
  AND n.turn = r.turn + 1 AND NOT n.agent))""")
view("replies_sql", """
SELECT run_id, turn, said AS text FROM (SELECT *, turn = max(turn) OVER (PARTITION BY run_id) AS last FROM {steps} WHERE agent)
WHERE last OR stop_reason IN ('end_turn', 'stop')""")


@query("t01_steps", "SELECT run_id, turn, md5(said) AS text_md5, len(said)::INT AS n FROM {steps}")
def t01(t):
    return t.steps.select("run_id", "turn", F.md5("text").alias("text_md5"),
                          F.length("text").alias("n"))


@query("t01_speaker_roles", """
SELECT run_id, turn, CASE WHEN agent AND dialect = 1 THEN 'agent' ELSE role END AS speaker,
  CASE role WHEN 'assistant' THEN 'model' WHEN 'user' THEN 'task' WHEN 'system' THEN 'result' ELSE 'other' END AS role
FROM {steps}""")
def t01_roles(t):
    return t.steps.select("run_id", "turn", "speaker", "role")


@query("s06_transcript_documents", "SELECT run_id, count(*) AS n_records FROM {turns} GROUP BY run_id")
def s06(t):
    """Whole transcript documents, one list of records each, read back as records."""
    parts = t.records_json.groupBy("run_id").agg(
        F.concat(F.lit('{"messages":['), F.array_join(F.transform(F.array_sort(F.collect_list(
            F.struct("turn", "record"))), lambda s: s["record"]), ","), F.lit("]}")).alias("document"))
    return src.records_of(parts).groupBy("run_id").agg(F.count("*").alias("n_records"))


@query("w05_reply_boundary", "SELECT run_id, turn, md5(text) AS text_md5 FROM {replies_sql}")
def w05(t):
    return transcripts.replies(t.steps).select("run_id", "turn", F.md5("text").alias("text_md5"))


@query("t02_final_answer", """
SELECT run_id,
  md5(string_agg(text, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY turn)) AS text_md5
FROM {replies_sql} GROUP BY ALL""")
def t02(t):
    return transcripts.final_answer(t.steps).select("run_id", F.md5("text").alias("text_md5"))


@query("t02_answer_file", f"""
SELECT run_id, md5(coalesce(nullif({duck.strip("text")}, ''), '')) AS text_md5 FROM (
SELECT run_id, CASE WHEN turn % 2 = 0 THEN text ELSE 'kept' END AS text FROM {{turns}} WHERE turn = 0 AND run_id % 3 = 0
UNION ALL SELECT run_id, string_agg(text, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY turn) FROM {{replies_sql}}
WHERE run_id NOT IN (SELECT run_id FROM {{turns}} WHERE turn = 0 AND run_id % 3 = 0) GROUP BY run_id)""")
def t02_file(t):
    mark = F.lit(fixed.FINAL_MARK)
    files = t.turns.where("turn = 0 AND run_id % 3 = 0").select(
        "run_id", F.concat(F.lit("draft"), mark, F.col("text"), mark, F.lit("tail")).alias("text"))
    return transcripts.final_answer(t.steps, files).select("run_id", F.md5("text").alias("text_md5"))


@query("t03_tool_calls", """
SELECT run_id, turn, 'bash' AS tool, command, CASE WHEN dialect = 0 THEN 'step ' || turn ELSE '' END AS description,
  call_id FROM {turns} WHERE agent""")
def t03(t):
    return t.calls.select(
        "run_id", "turn", "tool", F.get_json_object("argument", "$.command").alias("command"),
        "description", "call_id")


@query("t04_tool_results", "SELECT run_id, turn, call_id, text FROM {result_rows_sql}")
def t04(t):
    return t.results.select("run_id", "turn", "call_id", "text")


@query("j04_calls_with_results", """
SELECT c.run_id, c.turn, c.call_id, r.text AS result FROM {turns} c
LEFT JOIN {result_rows_sql} r ON r.run_id = c.run_id AND r.call_id = c.call_id WHERE c.agent""")
def j04(t):
    return transcripts.calls_with_results(t.calls, t.results).select("run_id", "turn", "call_id", "result")


@query("t05_observed_text", f"""
SELECT run_id, count(*) AS n_rows, sum(len(text))::BIGINT AS n_chars FROM (
  SELECT run_id, said AS text FROM {{steps}} WHERE NOT agent UNION ALL SELECT run_id, text FROM {{result_rows_sql}}) GROUP BY run_id""")
def t05(t):
    return transcripts.observed_rows(t.steps, t.results).groupBy("run_id").agg(
        F.count("*").alias("n_rows"), F.sum(F.length("text")).alias("n_chars"))


_REQUESTS = """SELECT c.run_id, c.turn, 'site' || (c.run_id % 13) || '.example.com' AS hosts, r.text AS result
FROM {turns} c LEFT JOIN {result_rows_sql} r USING (run_id, call_id) WHERE c.agent AND c.command LIKE 'curl%'"""


def _requests(t):
    return web.web_requests(transcripts.calls_with_results(t.calls, t.results))


@query("t06_web_requests", f"SELECT run_id, turn, hosts FROM ({_REQUESTS})")
def t06(t):
    return _requests(t).select("run_id", "turn", F.array_join("hosts", ",").alias("hosts"))


@query("x22_hosts_in_calls", """
SELECT run_id, turn, CASE WHEN command LIKE 'curl%' THEN 'site' || (run_id % 13) || '.example.com' ELSE 'mirror.local' END AS host
FROM {turns} WHERE agent AND (command LIKE 'curl%' OR command LIKE '%mirror%')""")
def x22(t):
    return t.calls.select(
        "run_id", "turn", F.explode(tx.hosts_in(F.col("argument"))).alias("host"))


@query("a38_hosts_reached", f"""
SELECT run_id, hosts AS host, bool_or(coalesce(result, '') <> '') AS answered FROM ({_REQUESTS}) GROUP BY ALL""")
def a38(t):
    return web.hosts_reached(_requests(t))


view("blocked_domains", """
SELECT DISTINCT conv_id AS run_id, CASE WHEN conv_id % 3 = 0 THEN 'Example.com' WHEN conv_id % 3 = 1
  THEN 'site' || CAST(conv_id % 13 AS STRING) || '.example.com' ELSE 'ample.com' END AS domain FROM {conversations}""")


@query("j05_blocked_hosts", f"""
SELECT q.run_id, host, answered FROM (SELECT run_id, hosts AS host, bool_or(coalesce(result, '') <> '') AS answered
  FROM ({_REQUESTS}) GROUP BY ALL) q JOIN {{blocked_domains}} b ON b.run_id = q.run_id
  AND (host = lower(domain) OR suffix(host, '.' || lower(domain)))""")
def j05(t):
    return web.blocked_hosts_reached(web.hosts_reached(_requests(t)), t.blocked_domains).select(
        "run_id", "host", "answered")


view("browsing_labels", """
SELECT DISTINCT conv_id AS run_id, CASE WHEN conv_id % 4 = 0 THEN 'yes' WHEN conv_id % 4 = 1 THEN 'no'
  WHEN conv_id % 4 = 2 THEN 'yes' ELSE 'unsure' END AS browsing_required FROM {conversations}""")


@query("f16_browsing_label", f"""
SELECT run_id, browsing_required, coalesce(n, 0) AS requests, CASE
  WHEN browsing_required = 'no' AND n > 0 THEN 'label says no and the run made requests'
  WHEN browsing_required = 'yes' AND n IS NULL THEN 'label says yes and the run made no request' END AS note
FROM {{browsing_labels}} LEFT JOIN (SELECT run_id, count(*) AS n FROM ({_REQUESTS}) GROUP BY 1) USING (run_id)""")
def f16(t):
    counts = web.request_counts(_requests(t))
    return web.browsing_label(t.browsing_labels, counts, t.steps.select("run_id").distinct())


# --- figures --------------------------------------------------------------------

view("answers", """
SELECT conv_id AS run_id, 'The page gives ' || CAST(500000 + conv_id * 100 + turn AS STRING) || ' and the table '
  || CAST(conv_id * 37 + turn * 11 AS STRING) || ', about ' || CAST(conv_id * 10 + turn AS STRING) || '.25 each.' || chr(10)
  || 'I ran the check on data/file_' || CAST(turn AS STRING) || '.csv and wrote out/report_' || CAST(conv_id % 7 AS STRING)
  || '.csv from data/none_' || CAST(turn AS STRING) || '.json. ' || text AS text
FROM {conversations} WHERE role = 'assistant'""")
view("truths", """
SELECT conv_id AS run_id, 'The total is ' || CAST(500000 + conv_id * 100 + turn AS STRING) || ' and '
  || CAST(conv_id * 37 + turn * 11 + turn % 3 AS STRING) || ', not ' || CAST(turn AS STRING) || '.' AS text
FROM {conversations}""")
view("traps", """
SELECT conv_id AS run_id, 'data/file_' || CAST(turn AS STRING) || '.csv misleads to ' || CAST(conv_id * 37 + turn * 11 AS STRING) AS text
FROM {conversations} WHERE turn % 2 = 1""")
view("run_files", """
SELECT conv_id AS run_id, 'data/file_' || CAST(turn AS STRING) || '.csv' AS path FROM {conversations} WHERE turn % 3 <> 1
UNION ALL SELECT conv_id, 'my out-report_' || CAST(conv_id % 7 AS STRING) || '.csv' FROM {conversations} WHERE turn = 0 AND conv_id % 2 = 0""")


def _figs(view_name: str, where: str = "TRUE") -> str:
    return (f"SELECT DISTINCT run_id, value FROM (SELECT run_id, unnest({duck.numbers('text')}) AS value "
            f"FROM {{{view_name}}}) WHERE {where}")


view("answer_figs", _figs("answers"))
view("truth_figs", _figs("truths"))
view("trap_figs", _figs("traps"))
view("all_result_figs", _figs("result_rows_sql"))


@query("x01_numbers_in_documents", f"""
SELECT doc_id, array_to_string(list_sort({duck.numbers('text')}), ' ') AS numbers FROM {{documents}}""")
def x01(t):
    from gaugeworks.functions.numbers import numbers_in
    return t.documents.select("doc_id", F.array_join(F.array_sort(numbers_in(F.col("text"))), " ")
                              .alias("numbers"))


@query("x02_canonical_number", f"SELECT run_id, value FROM ({_figs('answers')})")
def x02(t):
    return provenance.figure_rows(t.answers)


@query("u03_union_of_figures", "SELECT run_id, count(*) AS n FROM (SELECT * FROM {answer_figs} UNION SELECT * FROM {truth_figs} UNION SELECT * FROM {trap_figs}) GROUP BY run_id")
def u03(t):
    return provenance.union_of_figures(t.answers, t.truths, t.traps).groupBy("run_id").agg(
        F.count("*").alias("n"))


@query("j06_unsourced_figures", f"""
SELECT run_id, value FROM {{answer_figs}} a WHERE {duck.interesting('value')}
  AND NOT EXISTS (SELECT 1 FROM {{all_result_figs}} r WHERE r.run_id = a.run_id AND r.value = a.value)""")
def j06(t):
    return provenance.unsourced_figures(t.answers, t.results)


@query("k01_eight_per_check", f"""
SELECT run_id, value FROM (SELECT run_id, value, row_number() OVER (PARTITION BY run_id ORDER BY CAST(value AS DOUBLE), value) AS rn
  FROM {{answer_figs}} a WHERE {duck.interesting('value')}
  AND NOT EXISTS (SELECT 1 FROM {{all_result_figs}} r WHERE r.run_id = a.run_id AND r.value = a.value)) WHERE rn <= 8""")
def k01(t):
    found = provenance.unsourced_figures(t.answers, t.results)
    return provenance.first_per_run(found, F.col("value").try_cast("double"), "value")


@query("j07_truth_figures_missing", f"""
SELECT run_id, value FROM {{truth_figs}} t WHERE {duck.interesting('value')}
  AND NOT EXISTS (SELECT 1 FROM {{answer_figs}} r WHERE r.run_id = t.run_id AND r.value = t.value)""")
def j07(t):
    return provenance.missing_from_answer(t.truths, t.answers)


@query("j08_planted_figures", f"""
SELECT run_id, value FROM {{trap_figs}} t WHERE {duck.interesting('value')}
  AND EXISTS (SELECT 1 FROM {{answer_figs}} r WHERE r.run_id = t.run_id AND r.value = t.value)
  AND NOT EXISTS (SELECT 1 FROM {{truth_figs}} r WHERE r.run_id = t.run_id AND r.value = t.value)""")
def j08(t):
    return provenance.planted_figures(t.traps, t.answers, t.truths)


_LOOKUP = f"""
SELECT run_id, value FROM {{truth_figs}} t WHERE {duck.interesting('value')}
  AND (run_id, value) IN (SELECT (run_id, value) FROM {{answer_figs}})
  AND (run_id, value) IN (SELECT (run_id, value) FROM (SELECT run_id, unnest({duck.numbers('result')}) AS value FROM ({_REQUESTS})))
  AND (run_id, value) NOT IN (SELECT (run_id, value) FROM (SELECT run_id, unnest({duck.numbers('text')}) AS value
    FROM {{result_rows_sql}} WHERE text NOT LIKE 'page says%'))"""


def _lookups(t):
    return provenance.looked_up_figures(t.truths, t.answers, t.results, web.web_requests(t.calls))


@query("t07_answer_looked_up", _LOOKUP)
def t07(t):
    return _lookups(t)


@query("u02_lookup_set_operations", _LOOKUP.replace("SELECT run_id, value FROM {truth_figs}", "SELECT run_id, count(*) AS n FROM {truth_figs}", 1) + " GROUP BY run_id")
def u02(t):
    return _lookups(t).groupBy("run_id").agg(F.count("*").alias("n"))


# --- files ----------------------------------------------------------------------

view("answer_paths", f"SELECT DISTINCT run_id, unnest({duck.paths('text')}) AS path FROM {{answers}}")
view("seen_text", "SELECT run_id, said AS text FROM {steps} WHERE NOT agent UNION ALL SELECT run_id, text FROM {result_rows_sql}")


@query("x07_paths_in_answers", "SELECT run_id, path FROM {answer_paths}")
def x07(t):
    return provenance.cited_paths(t.answers)


@query("j19_unknown_paths", f"""
SELECT run_id, path, CASE WHEN EXISTS (SELECT 1 FROM {{turns}} c WHERE c.agent AND c.run_id = a.run_id
    AND contains(c.command, {duck.base_name('a.path')})) THEN 'check' ELSE 'strong' END AS level
FROM {{answer_paths}} a WHERE regexp_matches(path, '\\.(csv|json|txt|md|py|log|html)$')
  AND NOT EXISTS (SELECT 1 FROM {{run_files}} f WHERE f.run_id = a.run_id AND (f.path = a.path
    OR {duck.base_name('f.path')} = {duck.base_name('a.path')}
    OR regexp_matches({duck.base_name('f.path')}, '[ _-]' || regexp_escape({duck.base_name('a.path')}) || '$')))
  AND NOT EXISTS (SELECT 1 FROM {{seen_text}} s WHERE s.run_id = a.run_id AND contains(s.text, {duck.base_name('a.path')}))""")
def j19(t):
    return provenance.unknown_paths(t.answers, t.run_files, transcripts.observed_rows(t.steps, t.results),
                                    transcripts.action_rows(t.calls)).select("run_id", "path", "level")


@query("j20_claimed_files", f"""
SELECT DISTINCT run_id, 'out/report_' || (run_id % 7) || '.csv' AS path FROM {{answers}} a
WHERE NOT EXISTS (SELECT 1 FROM {{run_files}} f WHERE f.run_id = a.run_id AND {duck.base_name('f.path')} = 'report_' || (a.run_id % 7) || '.csv')
UNION SELECT DISTINCT a.run_id, p.path FROM {{answers}} a JOIN {{answer_paths}} p ON p.run_id = a.run_id
  AND p.path LIKE 'data/none%' AND contains(a.text, p.path)""")
def j20(t):
    none = t.run_files.limit(0)
    return provenance.unproduced_files(t.answers, t.run_files, none,
                                       transcripts.observed_rows(t.steps, t.results), t.answers)


@query("j21_misleading_files_cited", """
SELECT DISTINCT t.run_id, f.path FROM {traps} t JOIN {run_files} f ON f.run_id = t.run_id AND starts_with(t.text, f.path || ' ')
WHERE EXISTS (SELECT 1 FROM {answers} a WHERE a.run_id = t.run_id AND contains(a.text, f.path))""")
def j21(t):
    return provenance.misleading_files_cited(t.traps, t.run_files, t.answers)


view("review_findings", """
SELECT conv_id AS run_id, turn, CASE WHEN turn % 2 = 0 THEN CAST(conv_id * 37 + turn * 11 AS STRING)
  ELSE 'data/file_' || CAST(turn AS STRING) || '.csv' END AS subject,
  CASE WHEN turn % 2 = 0 THEN 'figure' ELSE 'path' END AS subject_kind FROM {conversations}""")
view("negative_lines", """
SELECT conv_id AS run_id, '[-5] Response states ' || CAST(conv_id * 37 + turn * 11 AS STRING) || '.0 or cites data/file_'
  || CAST(turn + 1 AS STRING) || '.csv' AS text FROM {conversations} WHERE turn % 4 = 0""")


@query("j22_uncovered_findings", f"""
SELECT run_id, subject, subject_kind FROM {{review_findings}} f WHERE CASE subject_kind
  WHEN 'figure' THEN NOT EXISTS (SELECT 1 FROM (SELECT run_id, unnest({duck.numbers('text')}) AS v FROM {{negative_lines}}) n
    WHERE n.run_id = f.run_id AND n.v = f.subject)
  ELSE NOT EXISTS (SELECT 1 FROM {{negative_lines}} n WHERE n.run_id = f.run_id AND contains(n.text, f.subject)) END""")
def j22(t):
    return provenance.uncovered(t.review_findings, t.negative_lines).select(
        "run_id", "subject", "subject_kind")


@query("x08_action_claims", "SELECT DISTINCT run_id, 'ran' AS verb FROM {answers}")
def x08(t):
    return provenance.action_claims(t.answers).where("verb = 'ran'").select("run_id", "verb").distinct()


@query("x08_unmatched_claims", """
SELECT DISTINCT a.run_id, a.sentence FROM (
  SELECT run_id, 'I checked zz' || (run_id % 5) || 'qq' || (turn * 7) || '.dat for it.' AS sentence,
    'zz' || (run_id % 5) || 'qq' || (turn * 7) || '.dat' AS w FROM {turns} WHERE agent) a
WHERE NOT EXISTS (SELECT 1 FROM (SELECT run_id, 'see xzz' || (run_id % 5) || 'qq' || (turn * 14) || '.dat2' AS text FROM {turns}) s
  WHERE s.run_id = a.run_id AND contains(s.text, a.w))""")
def x08b(t):
    said = t.turns.where("agent").selectExpr(
        "run_id", "concat('I checked zz', run_id % 5, 'qq', turn * 7, '.dat for it.') AS text")
    seen = t.turns.selectExpr("run_id", "concat('see xzz', run_id % 5, 'qq', turn * 14, '.dat2') AS text")
    return provenance.unmatched_claims(said, seen).select("run_id", "sentence")


@query("t10_files_opened", f"""
SELECT run_id, path, EXISTS (SELECT 1 FROM {{seen_text}} s WHERE s.run_id = f.run_id AND
  (contains(s.text, path) OR contains(s.text, {duck.base_name('path')}))) AS opened FROM {{run_files}} f""")
def t10(t):
    return transcripts.files_opened(transcripts.observed_rows(t.steps, t.results), t.run_files)


@query("t10_command_contains", "SELECT run_id, bool_or(contains(command, 'apt-get install')) AS seen FROM {turns} WHERE agent GROUP BY run_id")
def t10b(t):
    return transcripts.fragment_seen(transcripts.action_rows(t.calls), "apt-get install")


# --- packages -------------------------------------------------------------------

_INSTALLS = """
SELECT DISTINCT run_id, ecosystem, spec FROM (
  SELECT run_id, 'pip' AS ecosystem, 'pkg' || (run_id % 9) || '==1.' || turn AS spec FROM {turns} WHERE agent AND command LIKE 'pip %'
  UNION ALL SELECT run_id, 'pip', 'lib' || (run_id % 5) FROM {turns} WHERE agent AND command LIKE 'pip %'
  UNION ALL SELECT run_id, 'apt', 'tool' || (run_id % 4) FROM {turns} WHERE agent AND command LIKE 'sudo%'
  UNION ALL SELECT run_id, 'pip', 'scipy' FROM {turns} WHERE agent AND command LIKE 'python3%')"""


def _commands(t):
    return t.calls.select(
        "run_id", F.get_json_object("argument", "$.command").alias("text"))


@query("t08_installs", _INSTALLS)
def t08(t):
    return packages.installs(_commands(t))


@query("t09_dead_ends", """
SELECT DISTINCT run_id, note FROM (
  SELECT run_id, 'apt could not find tool' || (run_id % 4) AS note FROM {result_rows_sql} WHERE text LIKE 'E: Unable%'
  UNION ALL SELECT run_id, 'no module pkg' || (run_id % 9) || '.core' FROM {result_rows_sql} r WHERE text LIKE 'ModuleNot%'
    AND NOT EXISTS (SELECT 1 FROM {turns} c WHERE c.agent AND c.run_id = r.run_id AND c.command LIKE 'pip %'))""")
def t09(t):
    return packages.dead_ends(t.results, packages.installs(_commands(t)))


view("declared_packages", """
SELECT DISTINCT conv_id AS run_id, 'pip' AS ecosystem, 'Lib' || CAST(conv_id % 5 AS STRING) || '>=2' AS spec
FROM {conversations} WHERE conv_id % 2 = 0""")


@query("j23_undeclared_packages", f"""
SELECT run_id, ecosystem, spec FROM ({_INSTALLS}) i
WHERE NOT (spec LIKE 'lib%' AND run_id % 2 = 0)
  AND NOT (ecosystem = 'apt' AND EXISTS (SELECT 1 FROM {{result_rows_sql}} r WHERE r.run_id = i.run_id AND text LIKE 'E: Unable%'))""")
def j23(t):
    return packages.undeclared(packages.installs(_commands(t)), t.declared_packages,
                               packages.refused_packages(t.results)
                               ).select("run_id", "ecosystem", "spec")


@query("a37_environment_digest", """
SELECT run_id, sha256('{{"blocked":[' || coalesce(b, '') || '],"packages":[' || coalesce(p, '') || ']}}') AS environment_sha256
FROM (SELECT run_id, string_agg('"' || domain || '"', ',' ORDER BY domain) AS b FROM {blocked_domains} GROUP BY 1)
FULL JOIN (SELECT run_id, string_agg('"' || ecosystem || ' ' || spec || '"', ',' ORDER BY spec) AS p FROM {declared_packages} GROUP BY 1)
USING (run_id)""")
def a37(t):
    return packages.environment_digest(t.declared_packages, t.blocked_domains)


# --- sessions -------------------------------------------------------------------

view("session_base", """
SELECT conv_id AS run_id, turn AS position, '2024-01-01T00:' || CASE WHEN (turn * 7) % 60 < 10 THEN '0' ELSE '' END
  || CAST((turn * 7) % 60 AS STRING) || ':00Z' AS timestamp,
  CASE WHEN turn % 5 = 4 THEN '' ELSE 'm' || CAST(CAST(FLOOR(turn / 2.0) AS BIGINT) AS STRING) END AS message_id,
  CAST(length(text) * 7 AS BIGINT) AS input_tokens, CAST(turn * 100 AS BIGINT) AS cache_creation_input_tokens,
  CAST(turn * 5000 AS BIGINT) AS cache_read_input_tokens, CAST(length(text) AS BIGINT) AS output_tokens,
  text, turn % 3 <> 2 AS has_usage, conv_id, turn FROM {conversations}""")
view("session_lines", f"""
SELECT run_id, position, CASE WHEN turn % 7 = 6 THEN '{{{{broken' ELSE '{{{{"timestamp":"' || timestamp || '","message":{{{{"id":"' || message_id || '"'
  || CASE WHEN has_usage THEN ',"usage":{{{{"input_tokens":' || CAST(input_tokens AS STRING) || ',"cache_creation_input_tokens":'
  || CAST(cache_creation_input_tokens AS STRING) || ',"cache_read_input_tokens":' || CAST(cache_read_input_tokens AS STRING)
  || ',"output_tokens":' || CAST(output_tokens AS STRING) || '}}}}' ELSE '' END
  || ',"content":[{{{{"type":"tool_result","content":"' || {_esc('text')} || '"}}}}]}}}}}}}}' END AS line FROM {{session_base}}""")
view("session_sql", "SELECT * FROM {session_base} WHERE turn % 7 <> 6")


@built("sessions", "SELECT * FROM {session_sql}")
def sessions(t: Inputs):
    return src.session_rows(t.session_lines)


@query("s05_session_scan", """
SELECT run_id, position, timestamp, message_id, has_usage, CASE WHEN has_usage THEN input_tokens ELSE 0 END AS input_tokens FROM {sessions}""")
def s05(t):
    return t.sessions.select("run_id", "position", "timestamp", "message_id", "has_usage", "input_tokens")


_SIZE = "input_tokens + cache_creation_input_tokens + cache_read_input_tokens"
_CONTEXT = f"""
SELECT run_id, calls, calls >= 2 AS measured, CASE WHEN calls >= 2 THEN peak END AS context_peak,
  CASE WHEN calls >= 2 THEN base END AS context_baseline, CASE WHEN calls >= 2 THEN peak - base END AS context_added,
  CASE WHEN calls >= 2 THEN peak - base + 5000 END AS context_reported,
  CASE WHEN calls < 2 THEN NULL WHEN peak - base + 5000 < 32000 THEN 'under_32k' WHEN peak - base + 5000 < 64000 THEN '32k_64k' ELSE 'over_64k' END AS context_band
FROM (SELECT run_id, count(*) FILTER (has_usage AND {_SIZE} > 0) AS calls, max({_SIZE}) FILTER (has_usage) AS peak,
  arg_min({_SIZE}, (timestamp, position)) FILTER (has_usage AND {_SIZE} > 0) AS base FROM {{sessions}} GROUP BY run_id)"""


@query("a22_context_size", _CONTEXT)
def a22(t):
    return transcripts.context_size(t.sessions)


@query("f17_token_band", f"SELECT run_id, position, CASE WHEN {_SIZE} < 32000 THEN 'under_32k' WHEN {_SIZE} < 64000 THEN '32k_64k' ELSE 'over_64k' END AS band FROM {{sessions}} WHERE has_usage")
def f17(t):
    return t.sessions.where("has_usage").select("run_id", "position", token_band(transcripts.prompt_size()).alias("band"))


@query("a23_token_totals", """
SELECT run_id, sum(input_tokens)::BIGINT AS input_tokens, sum(cache_creation_input_tokens)::BIGINT AS cache_creation_input_tokens,
  sum(cache_read_input_tokens)::BIGINT AS cache_read_input_tokens, sum(output_tokens)::BIGINT AS output_tokens,
  sum(input_tokens + cache_creation_input_tokens + cache_read_input_tokens + output_tokens)::BIGINT AS total
FROM (SELECT *, row_number() OVER (PARTITION BY run_id, message_id ORDER BY timestamp, position) AS rn FROM {sessions} WHERE has_usage)
WHERE rn = 1 OR message_id = '' GROUP BY run_id""")
def a23(t):
    return transcripts.token_totals(t.sessions)


@query("a24_returned_tokens", "SELECT run_id, CAST(floor(sum(len(text)) / 4) AS BIGINT) AS context_from_files FROM {sessions} GROUP BY run_id")
def a24(t):
    return transcripts.returned_tokens(t.sessions)


@query("t11_run_counts", f"""
SELECT run_id, why = '' AS counted, why FROM (SELECT r.run_id, CASE WHEN a.run_id IS NULL THEN 'no_answer'
  WHEN r.run_id % 5 = 0 THEN 'no_files'
  WHEN l.run_id IS NOT NULL THEN 'looked_up' ELSE '' END AS why
FROM (SELECT DISTINCT run_id FROM {{turns}}) r LEFT JOIN (SELECT DISTINCT run_id FROM {{replies_sql}}) a USING (run_id)
LEFT JOIN (SELECT DISTINCT run_id FROM ({_LOOKUP})) l USING (run_id))""")
def t11(t):
    def flag(df, name):
        return df.select("run_id").distinct().withColumn(name, F.lit(True))
    every = t.steps.select("run_id").distinct()
    joined = (every.join(flag(transcripts.replies(t.steps), "_a"), "run_id", "left")
              .join(flag(_lookups(t), "_l"), "run_id", "left"))
    return transcripts.run_counts(joined.select(
        "run_id", F.lit(True).alias("has_transcript"), F.coalesce("_a", F.lit(False)).alias("has_answer"),
        (F.col("run_id") % 5 != 0).alias("has_files"), F.coalesce("_l", F.lit(False)).alias("looked_up")))


@query("f25_model_agreement", """
SELECT run_id, CASE WHEN run_id % 4 = 3 OR n = 0 THEN 'unknown' WHEN run_id % 4 = 0 THEN 'match' ELSE
  CASE WHEN run_id % 3 = 1 THEN 'match' ELSE 'mismatch' END END AS agreement
FROM (SELECT run_id, count(*) FILTER (agent) AS n FROM {turns} GROUP BY run_id)""")
def f25(t):
    asked = t.turns.select("run_id").distinct().selectExpr(
        "run_id", "CASE WHEN run_id % 4 = 3 THEN NULL WHEN run_id % 4 = 0 THEN concat('acme/alpha-', run_id % 3) "
                  "ELSE 'other/ALPHA-1' END AS requested")
    return transcripts.model_agreement(asked, transcripts.models_seen(t.records))


@query("f24_model_family", """
SELECT conv_id, turn, family FROM (SELECT conv_id, turn, CASE conv_id % 4 WHEN 0 THEN 'claude-x' || turn WHEN 1 THEN 'gemini'
  WHEN 2 THEN 'gpt' ELSE 'mix' || (turn % 3) END AS family FROM {conversations})""")
def f24(t):
    name = """CASE conv_id % 4 WHEN 0 THEN concat('Vendor/Claude-x', turn, '-large-20240101') WHEN 1 THEN 'g/pro-gemini-2[beta]'
      WHEN 2 THEN 'GPT-5' ELSE concat('lab/Mix', turn % 3, '-7b') END"""
    return t.conversations.selectExpr("conv_id", "turn", f"{name} AS model").select(
        "conv_id", "turn", tx.model_family(F.col("model")).alias("family"))


view("prompt_runs", """
SELECT conv_id * 100 + turn AS run_id, conv_id AS task_id, turn AS started, turn % 3 <> 2 AS counted,
  'w' || CAST(conv_id % 3 AS STRING) AS workspace_sha256, 'e' AS environment_sha256, 's' || CAST(turn % 2 AS STRING) AS sealed_sha256,
  'Work out the totals of the ' || CASE WHEN turn % 4 = 0 THEN 'yearly' WHEN turn % 4 = 1 THEN 'monthly' WHEN turn % 4 = 2
    THEN 'weekly and daily' ELSE 'old' END || ' tables for site ' || CAST(conv_id AS STRING) || CASE WHEN turn % 5 = 4 THEN ' and then explain every step you took' ELSE '' END AS prompt
FROM {conversations}""")


# The later prompts of a conversation are earlier ones with one, two or three words changed, or none.
view("later_prompts", """
SELECT run_id, workspace_sha256, environment_sha256, started, prompt AS base, CASE run_id % 4 WHEN 0 THEN prompt WHEN 1 THEN replace(prompt, 'totals', 'sums')
  WHEN 2 THEN replace(prompt, 'Work out', 'Please do work out') ELSE replace(prompt, 'Work out the totals of the', 'Find') || ' please' END AS prompt
FROM {prompt_runs} WHERE started >= 4""")


@query("j25_near_identical_run", """
WITH p AS (SELECT n.run_id, o.run_id AS like_run, o.started, CAST(CASE n.run_id % 4 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 2 END
    + CASE WHEN o.prompt = n.base THEN 0 ELSE 1 END AS BIGINT) AS words
  FROM {later_prompts} n JOIN {prompt_runs} o ON o.workspace_sha256 = n.workspace_sha256 AND o.environment_sha256 = n.environment_sha256
  WHERE n.run_id % 4 <> 3 AND o.started < 4 AND o.counted AND (o.prompt = n.base
    OR regexp_replace(o.prompt, 'site [0-9]+', 'site') = regexp_replace(n.base, 'site [0-9]+', 'site')
    OR regexp_replace(o.prompt, 'yearly|monthly|old', 'x') = regexp_replace(n.base, 'yearly|monthly|old', 'x'))),
r AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY words, started, like_run) AS rn FROM p WHERE words <= 2)
SELECT run_id, like_run, words FROM r WHERE rn = 1""")
def j25(t):
    now = t.later_prompts.select("run_id", "workspace_sha256", "environment_sha256", "prompt")
    return runs.near_identical(now, t.prompt_runs.where("started < 4")).select("run_id", "like_run", "words")


@query("w06_answer_changed", """
SELECT b.task_id, a.run_id AS from_run, b.run_id AS to_run, CAST(1 AS BIGINT) AS words FROM {prompt_runs} a JOIN {prompt_runs} b
  ON a.task_id = b.task_id AND b.started = a.started + 1 WHERE b.started % 4 IN (0, 1) AND b.started % 5 NOT IN (0, 4)""")
def w06(t):
    return runs.answer_changed_between(t.prompt_runs, max_rows=4_000)


# Two to five words no text has are put in, and as many words before them as there are, up to three, replaced.
@query("x18_words_changed", r"""
SELECT doc_id, CAST(2 + doc_id % 4 + least(doc_id % 3, len(list_filter(string_split_regex(text, '[ \t\n\v\f\r]+'), lambda w: w <> ''))) AS BIGINT) AS words
FROM {documents}""")
def x18(t):
    words = F.filter(F.split("text", r"\s+"), lambda w: w != "")
    swap = F.least(F.col("doc_id") % 3, F.size(words)).cast("int")
    half = F.greatest(swap, F.floor(F.size(words) / 2).cast("int"))
    new = F.transform(F.sequence(F.lit(1), (F.col("doc_id") % 4 + 2 + swap).cast("int")), lambda i: F.concat(F.lit("~new~"), i.cast("string")))
    after = F.concat(F.slice(words, 1, half - swap), new, F.slice(words, half + 1, F.size(words)))
    return t.documents.select("doc_id", tx.words_changed(F.col("text"), F.array_join(after, " ")).alias("words"))


@query("x20_prose_of_content", f"SELECT run_id, turn, md5({duck.strip('text')}) AS text_md5 FROM {{turns}}")
def x20(t):
    from gaugeworks.functions.udfs import prose_of_json
    body = F.coalesce(F.get_json_object("record", "$.message"), F.get_json_object("record", "$.content"))
    return t.records_json.select("run_id", "turn", F.md5(tx.strip(prose_of_json(body))).alias("text_md5"))


@query("x21_last_rating", """
SELECT run_id, turn, CASE WHEN turn % 2 = 0 THEN 'YES' ELSE 'no' END AS status, CAST(turn % 2 AS VARCHAR) AS score FROM {turns}""")
def x21(t):
    from gaugeworks.functions.udfs import last_rating
    reply = F.concat(F.lit('```json\n{"ratings":[{"status":"draft"}]}\n``` says {brace '), F.col("record"), F.lit(" so "),
                     F.format_string('{"ratings": [{"status": "%s", "score": %s, "justification": "a } in {text"}]} end',
                                     F.when(F.col("turn") % 2 == 0, "YES").otherwise("no"), F.col("turn") % 2))
    return t.records_json.select("run_id", "turn", last_rating(reply).alias("r")).select(
        "run_id", "turn", "r.status", "r.score")


@query("x24_steps_fitted", """
WITH b AS (SELECT run_id, turn, text, len(text) * 40 AS n FROM {turns}),
c AS (SELECT cap FROM (VALUES (10000), (5000), (2500), (1250), (625), (400), (0)) v(cap)),
s AS (SELECT run_id, cap, sum(CASE WHEN n > cap THEN cap + 33 + len(format('{{:,}}', n - cap)) ELSE n END) AS size FROM b, c GROUP BY ALL)
SELECT run_id, coalesce(max(cap) FILTER (size <= 20000), 0)::INT AS cap FROM s GROUP BY run_id""")
def x24(t):
    rows = t.turns.select("run_id", "turn", F.repeat("text", F.lit(40)).alias("observation"),
                          F.lit(0).alias("other_chars"))
    return transcripts.fit_steps(rows, budget=20_000).select("run_id", "cap").distinct()


@query("x23_middle_cut", """
SELECT doc_id, md5(CASE WHEN len(text) > 1000 THEN left(text, 500) || chr(10) || chr(10) || '... [' || (len(text) - 1000)
  || ' characters omitted from the middle] ...' || chr(10) || chr(10) || right(text, 500) ELSE text END) AS cut_md5 FROM {documents}""")
def x23(t):
    return t.documents.select("doc_id", F.md5(tx.middle_cut(F.col("text"), 1_000)).alias("cut_md5"))


view("suggestions", """
SELECT conv_id AS run_id, turn AS suggestion_id, 'Response states alpha' || CAST(turn % 4 AS STRING) || ' total beta gamma '
  || CAST(conv_id * 37 + turn * 11 AS STRING) || CASE WHEN turn % 2 = 0 THEN '' ELSE ' ' || role END AS text FROM {conversations}""")
view("written_lines", """
SELECT conv_id AS run_id, '[-3] Response claims the alpha' || CAST(turn % 3 AS STRING) || ' total beta gamma delta' AS text
FROM {conversations} WHERE turn % 2 = 0""")


def _content(x: str) -> str:
    stop = ", ".join(f"'{w}'" for w in fixed.FILLER_WORDS)
    tokens = rf"regexp_extract_all(lower({x}), '[a-z0-9][a-z0-9.\-]*[a-z0-9]|[a-z0-9]')"
    return (f"list_distinct(list_filter({tokens}, lambda w: w NOT IN ({stop}) AND (len(w) >= 3 OR regexp_full_match(w, '[0-9]+'))))")


@query("j13_suggestion_restates", rf"""
SELECT DISTINCT run_id, suggestion_id FROM (SELECT run_id, suggestion_id, {_content('text')} AS a FROM {{suggestions}}) s
JOIN (SELECT run_id, {_content(r"regexp_replace(text, '^\[[+-]?\d\]\s*', '')")} AS b FROM {{written_lines}}) w USING (run_id)
WHERE len(list_intersect(a, b)) = len(a) OR len(list_intersect(a, b)) * 10 >= (len(a) + len(b) - len(list_intersect(a, b))) * 6""")
def j13(t):
    return provenance.suggestion_restates(t.suggestions, t.written_lines)


@query("j13_against_true_answer", rf"""
WITH said AS (SELECT run_id, list_distinct(flatten(list({_content('text')}))) AS b FROM {{truths}} GROUP BY run_id)
SELECT run_id, suggestion_id FROM (SELECT run_id, turn AS suggestion_id, {_content('text')} AS a, text FROM (
  SELECT conv_id AS run_id, turn, 'total ' || (500000 + conv_id * 100 + turn) || ' ' || (conv_id * 37 + turn * 11) AS text FROM {{conversations}})) s
JOIN said USING (run_id) WHERE len(a) >= 3 AND list_has_all(b, a)
  AND NOT EXISTS (SELECT 1 FROM {{trap_figs}} f WHERE f.run_id = s.run_id AND list_contains({duck.numbers('s.text')}, f.value))""")
def j13b(t):
    mine = t.conversations.selectExpr(
        "conv_id AS run_id", "turn AS suggestion_id",
        "concat('total ', 500000 + conv_id * 100 + turn, ' ', conv_id * 37 + turn * 11) AS text")
    return provenance.suggestion_against_answer(mine, t.truths, t.traps)
