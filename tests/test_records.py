import json
import random

import pytest
from pyspark.sql import functions as F

from gaugeworks.functions import text as tx
from gaugeworks.functions.numbers import canonical_number, numbers_in
from gaugeworks.functions.tokens import visual_tokens
from gaugeworks.functions.udfs import last_rating
from gaugeworks.operators import criteria, findings, grading, manifests, materials, packages, provenance, runs, transcripts, whatif
from gaugeworks.plans import grade, review, vote
from gaugeworks.sources import documents as docs, readers, transcripts as src
from gaugeworks.streaming import sessions as live


def one(spark, **columns):
    row = {k: v for k, v in columns.items()}
    return spark.createDataFrame([tuple(row.values())], list(row))


def test_numbers(spark):
    df = one(spark, t="S19 has 2,383 of 01,10 and -4.50 or 1e3; x2 y_3 1,2345 53e2893413 0.0000001 7%")
    got = set(df.select(numbers_in(F.col("t")).alias("n")).first().n)
    assert {"2383", "1", "10", "-4.5", "1000", "2345", "7", "0.0"} <= got
    assert "19" not in got and "3" not in got and "12345" not in got
    assert one(spark, t="53e2893413").select(canonical_number(F.col("t"))).first()[0] == "53e2893413"


def test_dialects(spark):
    rows = [
        ("r", 0, {"role": "user", "content": "do it"}),
        ("r", 1, {"role": "assistant", "stop_reason": "tool_use", "content": [
            {"type": "text", "text": "looking"}, {"type": "tool_use", "id": "c1", "name": "bash",
                                                    "input": {"command": "ls", "description": "list"}}]}),
        ("r", 2, {"role": "user", "content": [{"type": "tool_result", "tool_use_id": "c1",
                                               "content": [{"type": "text", "text": "a.csv 42"}]}]}),
        ("r", 3, {"source": "agent", "message": "half", "extra": {"finish_reason": "end_turn"},
                  "tool_calls": [{"id": "c2", "function": {"name": "sh", "arguments": json.dumps(
                      {"cmd": "pip install scipy", "intent": "get it"})}}],
                  "observation": {"results": [{"source_call_id": "c2", "content": "ok"}, "bare"]}}),
        ("r", 4, {"role": "assistant", "isSidechain": True, "content": "from a helper"}),
        ("r", 5, {"role": "assistant", "content": [{"type": "text", "text": "done"}]}),
        ("r", 6, {"command": "wc -l a.csv", "description": "count"}),
    ]
    records = src.parse_records(spark.createDataFrame(
        [(a, b, json.dumps(c)) for a, b, c in rows] + [("r", 7, "{bad")], "run_id string, turn int, record string"))
    steps, calls, results = src.steps(records), src.tool_calls(records), src.tool_results(records)
    assert [r.text for r in transcripts.replies(steps).orderBy("turn").collect()] == ["half", "done"]
    assert transcripts.final_answer(steps).first().text == "half\n\n---\n\ndone"
    got = {(r.tool, r.call_id, r.description, r.argument) for r in calls.collect()}
    assert got == {("bash", "c1", "list", '{"command":"ls"}'), ("sh", "c2", "get it", '{"cmd":"pip install scipy"}'),
                   ("command", "", "count", "wc -l a.csv")}
    assert {(r.call_id, r.text) for r in results.collect()} == {("c1", "a.csv 42"), ("c2", "ok"), ("", "bare")}
    roles = {r.turn: r.role for r in steps.collect()}
    assert roles[1] == "model" and roles[4] == "helper" and roles[0] == "task"
    doc = spark.createDataFrame([("r", json.dumps({"steps": [c for _, _, c in rows]}))], "run_id string, document string")
    assert src.records_of(doc).count() == len(rows)


def test_last_rating_is_read_through_braces_and_fences(spark):
    reply = 'x {"ratings": [{"status": "NO"}]} ```{"a": "}"}``` {"ratings": [{"status": "YES", "score": 1}]} {"b": 2} {'
    r = one(spark, r=reply).select(last_rating("r").alias("x")).first().x
    assert (r.status, r.score) == ("YES", "1")


def test_run_score_is_the_signed_arithmetic(spark):
    rng = random.Random(2)
    lines = [(f"run{i % 3}", i, rng.choice([5, 3, 1, -1, -3, -5]), rng.choice(["1", "0", "x"])) for i in range(200)]
    df = spark.createDataFrame(lines, "run_id string, line_no int, weight int, score string").withColumn(
        "title", F.concat(F.lit("t"), "line_no")).withColumn("type", F.array(F.lit("task completion"))).withColumn(
        "status", F.lit(None).cast("string")).withColumn("refused", F.lit(False))
    got = {r.run_id: r for r in grading.run_scores(grading.graded(df)).collect()}
    for run, row in got.items():
        mine = [(w, s) for r, _, w, s in lines if r == run and s != "x"]
        up = sum(w for w, _ in mine if w > 0)
        won = sum(w for w, s in mine if w > 0 and s == "1") + sum(w for w, s in mine if w < 0 and s == "1")
        assert (row.max_reward, row.agent_score) == (up, won) and abs(row.rate - max(0, won / up)) < 1e-12
        assert row.passed == sum((s == "1") == (w > 0) for w, s in mine)
    again = grading.run_scores(grading.graded(df.orderBy(F.rand(1))))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, got.values()))


def test_repeats_against_the_greedy_walk(spark):
    rng = random.Random(9)
    rows = [(f"t{rng.randrange(4)}", f"l{rng.randrange(9)}", f"l{rng.randrange(9)}", rng.choice([None, *range(5)]), f"f{i:03d}")
            for i in range(120)]
    df = spark.createDataFrame(rows, "task_id string, criterion string, other_criterion string, index int, finding_id string")
    want = set()
    for task in {r[0] for r in rows}:
        gone = set()
        for _, a, b, _, _ in sorted((r for r in rows if r[0] == task), key=lambda r: (r[3] is None, r[3] or 0, r[4])):
            if a not in gone and b not in gone and a != b:
                gone.add(a)
                want.add((task, a))
    assert {tuple(r) for r in findings.repeats(df).collect()} == want


def test_repeats_of_a_large_task_in_small_parts(spark):
    rows = [("t", f"Line  {i}", f"line {i + 1 if i % 4 < 3 else i - 3}", i % 3, f"f{i:05d}", "", 3) for i in range(400)]
    rows += [("t", "line 5", "line 9999", 0, "e", "proven", 3), ("t", "line 6", "line 9998", 0, "s", "", 1), ("t", None, "x", 0, "n", "", 3)]
    df = spark.createDataFrame(rows, "task_id string, criterion string, other_criterion string, index int, finding_id string, exempt string, samples int")
    want, gone = set(), set()
    for _, a, b, *_ in sorted((r for r in rows[:400]), key=lambda r: (r[3], r[4])):
        x, y = " ".join(a.lower().split()), b
        if x not in gone and y not in gone:
            gone.add(x)
            want.add(("t", a))
    assert {tuple(r) for r in findings.repeats(df, 50).collect()} == want


def edits(x, y):
    row = list(range(len(y) + 1))
    for i, v in enumerate(x, 1):
        new = [i]
        for j, w in enumerate(y, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (v != w)))
        row = new
    return row[-1]


def test_near_identical_against_every_pair(spark):
    rng = random.Random(4)
    vocab = "alpha beta gamma delta".split()
    old = [(f"o{i}", i, "w", "e", True, " ".join(rng.choice(vocab) for _ in range(rng.randrange(1, 9)))) for i in range(40)]
    new = [(f"n{i}", "w", "e", " ".join(rng.choice(vocab) for _ in range(rng.randrange(1, 9)))) for i in range(25)]
    earlier = spark.createDataFrame(old, "run_id string, started int, workspace_sha256 string, environment_sha256 string, counted boolean, prompt string")
    now = spark.createDataFrame(new, "run_id string, workspace_sha256 string, environment_sha256 string, prompt string")

    def words(a, b):
        return edits(a.split(), b.split())

    want = {}
    for n, _, _, p in new:
        close = [(words(q, p), s, o) for o, s, _, _, _, q in old if words(q, p) <= 2]
        if close:
            want[n] = min(close)
    got = {r.run_id: (r.words, r.like_run) for r in runs.near_identical(now, earlier).collect()}
    assert got == {n: (w, o) for n, (w, _, o) in want.items()}


def test_weights_only_drop_against_every_pair(spark):
    rng = random.Random(8)
    grades = [(rng.randrange(3), i, i, rng.choice([0.2, 0.4, 0.6, 0.8])) for i in range(120)]
    sets = {i: {t: rng.choice([5, 3, 1]) for t in ("a", "b", "c")[: rng.choice([2, 3])]} for _, i, _, _ in grades}
    proposed = {(0, "a"): {3}, (1, "b"): {1}}
    want = set()
    for job, i, at, reward in grades:
        for j2, k, at2, r2 in sorted(grades, key=lambda g: -g[2]):
            if reward < 0.5 <= r2 and j2 == job and at2 < at and set(sets[k]) == set(sets[i]):
                moved = {t for t in sets[i] if sets[i][t] != sets[k][t] and sets[i][t] not in proposed.get((job, t), ())}
                if moved:
                    want |= {(job, i, k, t) for t in moved}
                    break
    g = spark.createDataFrame([(j, i, float(a), r) for j, i, a, r in grades], "job bigint, grade_id bigint, at double, reward double")
    lines = spark.createDataFrame([(j, i, t, w) for j, i, _, _ in grades for t, w in sets[i].items()],
                                  "job bigint, grade_id bigint, text string, weight int")
    p = spark.createDataFrame([(j, t, sorted(w)) for (j, t), w in proposed.items()], "job bigint, text string, weights array<int>")
    g = g.withColumn("at", F.timestamp_seconds("at"))
    for limit in (10_000, 20):
        got = {(r.job, r.grade_id, r.earlier_id, r.text) for r in whatif.weights_only_drops(g, lines, p, max_rows=limit).collect()}
        assert got == want


def test_containment_and_mirrors_with_copies(spark):
    rng = random.Random(11)
    words = "alpha beta gamma delta total units sample".split()
    rows = [(f"t{rng.randrange(2)}", i, rng.choice([5, 3, 1, -1, -3]), "completion", rng.choice(["user facing", "state change"]),
             "Response states S" + str(rng.randrange(3)) + " " + " ".join(rng.sample(words, rng.randrange(1, 4)))) for i in range(80)]
    rows += [(t, 100 + i, w, c, p, b) for i, (t, _, w, c, p, b) in enumerate(rows[:30])]
    df = spark.createDataFrame(rows, "task_id string, line_no int, weight int, category string, place string, criteria string")
    read = df.select("task_id", "line_no", "weight", "place", tx.marks(F.col("criteria")).alias("m"),
                     tx.wording(tx.normalise(F.col("criteria"))).alias("w")).collect()
    want = set()
    for task in ("t0", "t1"):
        mine = [r for r in read if r.task_id == task]
        pairs = [(-len(a.m), a.line_no, b.line_no) for a in mine for b in mine if a.line_no != b.line_no and (a.weight > 0) == (b.weight > 0)
                 and a.place == b.place and set(a.m) <= set(b.m) and set(a.w) <= set(b.w) and a.w
                 and not (set(a.m) == set(b.m) and b.line_no < a.line_no)]
        want |= {(task, a, b) for _, a, b in sorted(pairs)[:12]}
    assert {(r.task_id, r.first, r.second) for r in criteria.containment_pairs(df).collect()} == want


def test_paths_and_claims(spark):
    rows = lambda *t: spark.createDataFrame([("r", x) for x in t], "run_id string, text string")
    files = spark.createDataFrame([("r", "data/TRANSECT BIRD DATA.xlsx"), ("r", "a/b.csv")], "run_id string, path string")
    answer = rows("See DATA.xlsx, b.csv, made.json, seen.csv and ran.csv. I wrote out/new.csv today.")
    got = {(r.path, r.level) for r in provenance.unknown_paths(answer, files, rows("saw xseen.csv"), rows("cat ran.csv2")).collect()}
    assert got == {("made.json", "strong"), ("out/new.csv", "strong"), ("ran.csv", "check")}
    none = files.limit(0)
    left = provenance.unproduced_files(answer, none, files, rows("nothing"), answer)
    assert [r.path for r in left.collect()] == ["out/new.csv"]
    assert provenance.unproduced_files(answer, none, files, rows("saved as new.csv"), answer).isEmpty()


def test_installs(spark):
    cmd = "sudo -E apt-get install -y jq; FOO=1 pip3 install -i http://m scipy==1.2 ./x.whl -r r.txt 'numpy' && echo no pip install y"
    df = spark.createDataFrame([("r", cmd)], "run_id string, text string")
    assert {(r.ecosystem, r.spec) for r in packages.installs(df).collect()} == {("apt", "jq"), ("pip", "scipy==1.2"), ("pip", "numpy")}


def test_snapshot_skips_and_goes_on(spark):
    files = spark.createDataFrame([("r", "a", 60), ("r", "b", 50), ("r", "c", 40), ("r", "d", 500)], "run_id string, path string, bytes bigint")
    got = {r.path: r.state for r in manifests.snapshot(files, 400, 100).collect()}
    assert got == {"a": "kept", "b": "over_total", "c": "kept", "d": "over_file_cap"}


def test_outputs_shown_within_a_budget(spark):
    rng = random.Random(6)
    rows = [("r", f"p{i:03d}", rng.choice(["new", "changed"]), rng.randrange(4)) for i in range(60)]
    left, want = 20, {}
    for _, path, state, n in sorted(rows, key=lambda r: (r[2] != "new", r[1])):
        want[path] = (min(left, n), n > left)
        left -= min(left, n)
    df = spark.createDataFrame(rows, "run_id string, path string, state string, n_chars bigint")
    assert {r.path: (r.shown_chars, r.cut) for r in materials.shown_outputs(df, 20, 4).collect()} == want


def test_visual_tokens_against_the_walk_down(spark):
    sizes = [(1, 1), (28, 28), (1568, 1568), (4000, 3000), (100, 9000), (1092, 1092), (0, 5)]

    def walk(w, h):
        if w <= 0 or h <= 0:
            return 0
        for e in range(min(max(w, h), 1568), 0, -1):
            f = e / max(w, h)
            a, b = max(1, round(w * f)), max(1, round(h * f))
            if -(-a // 28) * -(-b // 28) <= 1568:
                return -(-a // 28) * -(-b // 28)
        return 1

    df = spark.createDataFrame(sizes, "w int, h int")
    assert [r[0] for r in df.select(visual_tokens(F.col("w"), F.col("h"))).collect()] == [walk(*s) for s in sizes]


def test_files_and_streams(spark, tmp_path):
    log = tmp_path / "jobs" / "runA"
    log.mkdir(parents=True)
    use = {"input_tokens": 10, "cache_creation_input_tokens": 5, "cache_read_input_tokens": 1, "output_tokens": 2}
    line = lambda i, m: json.dumps({"timestamp": f"2024-01-01T00:0{i}:00Z", "message": {"id": m, "usage": use}})
    (log / "s.jsonl").write_text("\n".join([line(0, "a"), line(1, "a"), "{bad", line(2, "b")]) + "\n")
    (log / "x_trajectory.json").write_text('[{"role": "user", "content": "hi"}]')
    assert readers.read_sessions(spark, str(tmp_path)).count() == 3
    assert src.records_of(readers.read_transcripts(spark, str(tmp_path)).select("path", "document")).count() == 1
    (tmp_path / "ws").mkdir()
    (tmp_path / "ws" / "a.csv").write_text("k,v")
    (tmp_path / "ws" / "b.bin").write_bytes(b"\0")
    corpus, unreadable = readers.read_workspace(spark, str(tmp_path / "ws"))
    assert corpus.count() == 1 and unreadable.count() == 1 and readers.list_files(spark, str(tmp_path / "ws")).count() == 2
    for kind in ("csv", "parquet"):
        readers.write_table(one(spark, a=1), str(tmp_path / kind), kind)
    assert spark.read.parquet(str(tmp_path / "parquet")).count() == 1
    (tmp_path / "c.yaml").write_text("rules:\n  limit: 0.5  # half\n  zones:\n    - \"A\"\n    - \"B\"\nname: x\n")
    assert readers._plain_yaml((tmp_path / "c.yaml").read_text()) == {"rules": {"limit": 0.5, "zones": ["A", "B"]}, "name": "x"}
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    query = (live.running_totals(live.session_stream(spark, str(tmp_path / "jobs"))).writeStream.outputMode("complete")
             .format("memory").queryName("totals").option("checkpointLocation", str(tmp_path / "ck")).start())
    query.processAllAvailable()
    query.stop()
    row = spark.sql("SELECT * FROM totals").first()
    assert (row.run_id, row.input_tokens, row.context_peak) == ("runA", 20, 16)


def test_plans(spark):
    lines = spark.createDataFrame([("r", 1, "a", 5), ("r", 2, "b", -3), ("r", 3, "c", 3)], "run_id string, line_no int, title string, weight int").withColumn(
        "type", F.array().cast("array<string>"))
    reply = lambda s: '{"ratings": [{"status": "%s"}]}' % s
    replies = spark.createDataFrame([("r", 1, reply("YES"), False), ("r", 2, reply("yes"), False), ("r", 3, "no json", False)],
                                    "run_id string, line_no int, reply string, refused boolean")
    tests = spark.createDataFrame([("r", "t", "passed", "", 1)], "run_id string, name string, status string, message string, weight int")
    states = spark.createDataFrame([("r", "graded", "ran")], "run_id string, judge_state string, unit_state string")
    out = grade.grade(lines, replies, tests, states)
    row = out["rewards"].first()
    assert (row.rubrics, row.reward, row.combined_score, row.combined_of) == (0.4, 0.5, 3, 6)
    said = spark.createDataFrame([("t", "s1", 1, "ground truth", "q", "inaccurate", "high", "x", "y", ["criterion 1"])],
                                 "task_id string, statement_id string, reading_no int, file string, quote string, reading string, "
                                 "confidence string, check string, what_is_wrong string, bears_on array<string>")
    cast = spark.createDataFrame([("t", "s1", s, 1, "inaccurate") for s in "ab"], "task_id string, statement_id string, slot string, vote_no int, verdict string")
    got = vote.decide(said, cast, ["a", "b"], said.select("task_id"))
    assert got["consistency"].first().verdict == "FAIL"
    record = json.dumps({"role": "assistant", "content": "The total is 123 per ghost.csv"})
    records = src.parse_records(spark.createDataFrame([("r", 0, record)], "run_id string, turn int, record string"))
    text = lambda *t: spark.createDataFrame([("r", x) for x in t], "run_id string, text string")
    paths = spark.createDataFrame([("r", "a.csv")], "run_id string, path string")
    hosts = spark.createDataFrame([("r", "x.com")], "run_id string, domain string")
    found = review.review(records, text("It is 456"), text("trap 123"), paths, paths, hosts, text("rows 9"), text("[-5] states 123"))
    checks = {(r.check, r.subject) for r in found["findings"].collect()}
    assert {("planted figure", "123"), ("figure not given", "456"), ("unknown file", "ghost.csv"), ("unsourced figure", "123")} <= checks


@pytest.mark.parametrize("body,flag", [
    ("Response states the second plasmid is right", "ordinal"), ("Response lists Pten in its first row of data", None),
    ("Response gives 4, and explains the reason", "two_claims"), ("Response gives a value between 4 and reports 6", None)])
def test_lint(spark, body, flag):
    row = criteria.lint(one(spark, task_id="t", line_no=1, criteria=body, weight=3, category="completion", place="user facing")).first()
    raised = {k for k in ("ordinal", "two_claims") if row[k]}
    assert raised == ({flag} if flag else set())


def test_documents(spark):
    kept, rejected = docs.criteria_lines(one(spark, d=1, text="## Completion\n- [5] [state] x.csv holds 3\n- [4] no\nplain\n## Odd\n- [1] lost"), "d")
    assert [(r.line_no, r.weight, r.type[1]) for r in kept.collect()] == [(2, 5, "state change")]
    assert {(r.line_no, r.problem) for r in rejected.collect()} == {
        (3, "weight not allowed"), (4, "not a heading or a bullet"), (5, "unknown heading"), (6, "not under a known heading")}


def test_repeats_in_rounds_and_folds_agree_on_a_chain(spark):
    rows = [("t", f"l{i:03d}", f"l{i + 1:03d}", i, f"f{i:03d}") for i in range(30)]
    df = spark.createDataFrame(rows, "task_id string, criterion string, other_criterion string, index int, finding_id string")
    fold = sorted(map(tuple, findings.repeats(df).collect()))
    assert fold == sorted(map(tuple, findings.repeats(df, fold_findings=1).collect())) and len(fold) == 30


def test_a_long_run_has_one_answer(spark):
    from gaugeworks.operators.transcripts import final_answer

    steps = spark.range(3000).select(F.lit(1).alias("run_id"), F.col("id").alias("turn"), F.lit(True).alias("is_own"),
                                     F.concat(F.lit("t"), "id").alias("text"), F.lit("end").alias("stop_reason"))
    got = final_answer(steps).collect()
    assert len(got) == 1 and got[0].text.startswith("t0") and got[0].text.endswith("t2999")


def test_crash_reads_past_blank_lines(spark):
    from gaugeworks.operators.grading import is_crash

    df = spark.createDataFrame([("\n AssertionError: x",), (None,), ("ValueError",), ("assert 1",)], "m string")
    assert [r[0] for r in df.select(is_crash(F.col("m"))).collect()] == [False, True, True, False]


def test_words_changed(spark):
    from gaugeworks.functions.text import words_changed

    rng = random.Random(9)
    rows = [("a b c", "a x c"), ("a b", "a b"), (None, "one two"), ("a b c d", "d"), ("a b", "x y z"), ("", None), (" a ", "a\nb"),
            ("x " * 30_000 + "y z", "x " * 30_000 + "w z"), ("é 😀 a", "é a")]
    rows += [tuple(" ".join(rng.choice("abcd") for _ in range(rng.randrange(12))) for _ in "ab") for _ in range(200)]
    df = spark.createDataFrame(rows, "a string, b string")
    got = df.select("a", "b", words_changed(F.col("a"), F.col("b")).alias("n"), words_changed(F.col("a"), F.col("b"), 2).alias("m")).collect()
    for r in got:
        x, y = (r.a or "").split(), (r.b or "").split()
        n = 1 if len(x) > 1000 else edits(x, y)
        assert r.n == n and r.m == (n if n <= 2 else None), (r, n)


def test_names_present_against_every_pair(spark):
    from gaugeworks.operators.occurrence import names_present

    rng = random.Random(8)
    texts = [(k % 3, "".join(rng.choice("ab./ M") for _ in range(rng.randint(0, 40)))) for k in range(30)]
    texts += [(1, "opened main.r, Makefile, out.parquetfile2 and my file.csv"), (1, "x" * 200_000 + "deep/in.it"), (2, None)]
    names = [(k % 3, "".join(rng.choice("ab./") for _ in range(rng.randint(1, 6)))) for k in range(60)]
    names += [(1, n) for n in ("main.r", "Makefile", "out.parquetfile2", "my file.csv", "deep/in.it", "absent", "", "é")] + [(0, None)]
    want = {(k, n) for k, n in names if n and any(t and k == j and n in t for j, t in texts)}
    got = names_present(spark.createDataFrame(names, "k int, path string"), spark.createDataFrame(texts, "k int, text string"), "k")
    assert {tuple(r) for r in got.collect()} == want


def test_snapshot_in_chunks_is_the_row_loop(spark):
    from gaugeworks.operators.manifests import snapshot

    rng = random.Random(21)
    rows = [(run, f"p{i:06d}", rng.choice([1, 2, 3, 50, 90, 100, 500])) for run, n in (("a", 3000), ("b", 40), ("c", 700), ("d", 1)) for i in range(n)]
    rows += [("e", f"{'é' if i % 2 else 'z'}{i:04d}", 98 - i % 40 if i % 2 else 1) for i in range(600)]
    want = {}
    for run in "abcde":
        total = 0
        for _, path, size in sorted((r for r in rows if r[0] == run), key=lambda r: r[1].encode()):
            state = "over_file_cap" if size > 100 else "over_total" if total + size > 2000 else "kept"
            total += size * (state == "kept")
            want[run, path] = (size, state)
    df = spark.createDataFrame(rows, "run_id string, path string, bytes int")
    for fold in (100_000, 64):
        got = {(r.run_id, r.path): (r.bytes, r.state) for r in snapshot(df, 100, 2000, fold).collect()}
        assert got == want
    assert snapshot(df.limit(0), 100, 2000).count() == 0


def test_weights_only_drop_far_back(spark):
    n = 2000
    grades = [(1, i, float(i), 0.9 if i < n else 0.1) for i in range(n + 1)]
    lines = [(1, i, t, 5 if t == "a" and i == 0 else 3) for i in range(n + 1) for t in ("a", "b")]
    g = spark.createDataFrame(grades, "job bigint, grade_id bigint, at double, reward double").withColumn("at", F.timestamp_seconds("at"))
    ls = spark.createDataFrame(lines, "job bigint, grade_id bigint, text string, weight int")
    p = spark.createDataFrame([], "job bigint, text string, weights array<int>")
    for limit in (10_000, 300):
        assert [tuple(r) for r in whatif.weights_only_drops(g, ls, p, max_rows=limit).collect()] == [(1, n, 0, "a", 5, 3)]


def test_containment_where_many_lines_share_one_mark(spark):
    from gaugeworks.operators.criteria import containment_pairs

    rng = random.Random(17)
    vocab = ["".join(rng.choice("bcdfghklm") for _ in range(5)) for _ in range(400)]
    lines = [(1, i, "S1 total " + " ".join(rng.sample(vocab, 30)), 3, "completion", "user facing") for i in range(300)]
    for i in range(8):
        lines.append((1, 1000 + i, lines[i * 3][2] + f" and S{i + 2} " + " ".join(rng.sample(vocab, 5)), 3, "completion", "user facing"))
    df = spark.createDataFrame(lines, "task_id int, line_no int, criteria string, weight int, category string, place string")
    got = {(r.first, r.second) for r in containment_pairs(df).collect()}
    assert got == {(i * 3, 1000 + i) for i in range(8)}


def test_sentences_and_prose_keep_digits_at_their_ends(spark):
    text = "It was so. 19.37.233.111 \n2 is even, 3 is not! 2012 came at 12\t\n"
    df = one(spark, t=text, p="first 0\n1 second 1\n2 third 2")
    got = df.select(tx.sentences(F.col("t")).alias("s"), tx.quote_for(F.col("t"), F.lit("37.23")).alias("q"), tx.prose(F.col("p")).alias("p")).first()
    assert got.s == ["It was so.", "19.37.233.111", "2 is even, 3 is not!", "2012 came at 12"]
    assert got.q == "19.37.233.111" and got.p == "first 0 1 second 1 2 third 2"


def test_sentence_count_keeps_a_line_of_digits(spark):
    # Trimmed of the line's place, "1 is one." lost the figure that opens a sentence.
    assert one(spark, t="It is so.\n1 is one.\n2 is two.").select(tx.sentence_count(F.col("t"))).first()[0] == 3


def test_near_identical_where_all_prompts_are_alike(spark):
    schema = "run_id int, started int, workspace_sha256 string, environment_sha256 string, counted boolean, prompt string"
    long = " ".join(f"w{i}" for i in range(60))
    earlier = spark.createDataFrame([(i, i % 3, "w", "e", True, f"find the totals of the old tables for site {i} {'and sum up ' * 2}") for i in range(1500)]
                                    + [(9000, 1, "w", "e", True, long)], schema)
    now = spark.createDataFrame([(i + 2000, 9, "w", "e", True, f"find the sums of the old tables for site {i} {'and sum up ' * 2}") for i in range(0, 3000, 2)]
                                + [(9001, 9, "w", "e", True, long.replace("w30 ", ""))], schema)
    plan = runs.near_identical(now, earlier)
    got = {r.run_id: (r.words, r.like_run) for r in plan.collect()}
    # The site itself where it was asked before, else the first of all sites.
    assert got == {**{i + 2000: (1, i) if i < 1500 else (2, 0) for i in range(0, 3000, 2)}, 9001: (1, 9000)}
    forms = runs._met_by_forms(now.where("run_id < 9000").select("workspace_sha256", "environment_sha256", "prompt"), earlier)
    assert forms.count() == 1500


def test_a_text_table_of_one_row_group_is_many_tasks(spark, tmp_path, monkeypatch):
    from gaugeworks.catalog import base

    spark.range(2000).select(F.col("id").alias("doc_id"), F.md5(F.col("id").cast("string")).alias("text")).coalesce(1).write.parquet(
        str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(base, "ONE_SPLIT", 4_000)
    docs_read = base.Inputs(spark, str(tmp_path)).documents
    parts = docs_read.select(F.spark_partition_id().alias("p"), "doc_id")
    assert parts.count() == 2000 and parts.agg(F.countDistinct("p")).first()[0] > 2 * spark.sparkContext.defaultParallelism


def test_long_names_meet_few_texts(spark):
    from gaugeworks.operators import occurrence

    # Any four letters of these stand in every text; sixteen stand in the name's own text only.
    rng = random.Random(6)
    texts = ["".join(rng.choice("abc") for _ in range(1500)) for _ in range(40)]
    names = [t[700:760] for t in texts] + ["abca", texts[3][20:36], texts[4][20:35], "c" * 16]
    asked = spark.createDataFrame([("k", n) for n in names], "k string, path string")
    held = spark.createDataFrame([("k", i, t) for i, t in enumerate(texts)], "k string, text_id int, text string")
    got = {(r.path, r.text_id) for r in occurrence.found_in(asked, held, "k").collect()}
    assert got == {(n, i) for n in names for i, t in enumerate(texts) if n in t}
    assert occurrence.LONG_GRAM in occurrence.WIDTHS and occurrence.LONG_GRAM <= occurrence.ENDS


def test_names_meet_texts_without_a_string_for_each_stretch(spark):
    from gaugeworks.operators import occurrence

    draw = random.Random(8)
    letters = "abé \U0001F600"
    texts = [(k, i, "".join(draw.choice(letters) for _ in range(draw.choice((0, 3, 40, 300))))) for k in (1, 2) for i in range(12)]
    cut = [(k, t[a:a + draw.choice((1, 2, 3, 4, 15, 16, 17, 33, 80))]) for k, _, t in texts for a in (0, 7, 90)]
    names = cut + [(3 - k, n) for k, n in cut] + [(1, None), (2, "absent from all of these")]
    asked = spark.createDataFrame(names, "k int, path string")
    found = occurrence.found_in(asked, spark.createDataFrame(texts, "k int, text_id int, text string"), "k")
    got = [(r.k, r.path, r.text_id) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == {
        (k, n, i) for k, n in names if n for kk, i, t in texts if k == kk and n in t}
    assert "regexp_extract_all(text" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_rejected_lines_are_told_in_one_pass(spark):
    text = "- [5] above\n## Odd\nprose\n- [5] under it\n\n## Completion\nprose\n- [2] off\n- [3] fine\n"
    kept, rejected = docs.criteria_lines(spark.createDataFrame([(1, text), (2, None)], "doc_id int, text string"), "doc_id")
    assert sorted((r.line_no, r.problem) for r in rejected.collect()) == [
        (1, "not under a known heading"), (2, "unknown heading"), (3, "not a heading or a bullet"),
        (4, "not under a known heading"), (7, "not a heading or a bullet"), (8, "weight not allowed")]
    assert [(r.line_no, r.weight, r.criteria) for r in kept.collect()] == [(9, 3, "fine")]
    assert "Union" not in rejected._jdf.queryExecution().optimizedPlan().toString()


def test_a_batch_of_texts_is_folded_a_few_at_a_time():
    import tracemalloc
    import unicodedata

    import pyarrow as pa

    texts = pa.array([None, ""] + ["é" * 20_000] * 1000)
    tracemalloc.start()
    try:
        got = tx._nfkd.func(texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert got[:3].to_pylist() == [None, "", unicodedata.normalize("NFKD", "é" * 20_000)] and len(got) == 1002
    assert peak < 16 << 20


def test_lines_meet_on_numbers_moved_once(spark):
    from gaugeworks.operators import criteria as crit

    rng = random.Random(11)
    words = [f"word{c}" for c in "abcdefgh"]
    made = [(f"t{i % 3}", i, " ".join(rng.sample(words, rng.randint(1, 6)) + [f"S{rng.randint(1, 3)}x"] * rng.randint(0, 1)),
             rng.choice((5, -1)), "completion", rng.choice(("user facing", "state change"))) for i in range(90)]
    lines = spark.createDataFrame(made, "task_id string, line_no bigint, criteria string, weight int, category string, place string")
    found = crit.containment_pairs(lines, 5)

    def holds(a, b):
        x, y = set(a[2].lower().split()), set(b[2].lower().split())
        marks = {w for w in x if w.startswith("s")}
        same = marks == {w for w in y if w.startswith("s")}
        return a[0] == b[0] and a[1] != b[1] and (a[3] > 0, a[5]) == (b[3] > 0, b[5]) and marks and len(x) > len(marks) and x <= y and (
            not same or a[1] < b[1])
    want = {(a[0], a[1], b[1], 1) for t in ("t0", "t1", "t2") for a, b in [(a, b) for a in made if a[0] == t for b in made if holds(a, b)][:5]}
    assert {tuple(r) for r in found.collect()} == want
    # What is moved to meet is a number, not the mark or word.
    assert "min_by(element#" in (plan := found._jdf.queryExecution().optimizedPlan().toString()) and "hash(" in plan


def test_a_quotation_cut_from_a_short_prompt_is_one(spark, tmp_path):
    import duckdb

    import __spark_entry__ as entry

    name = "t15_evidence_bar"
    texts = ["ab", *(f"word {i} of a longer text, such as {i * 7 % 90 + 10} units{'x' * (i % 4)}" for i in range(1, 60))]
    spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)],
                          "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    con = duckdb.connect()
    for table in ("documents", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    sql = con.sql(entry.oracle_sql()[name])
    want = {repr(r) for r in sql.fetchall()}
    got = {repr(tuple(r)) for r in entry.queries()[name](spark, str(tmp_path)).select(*sql.columns).collect()}
    assert got == want and ("s-0", 54, "quote not in the prompt") in {(r[0], r[1], r[3]) for r in sql.select("task_id, finding_no, category, why").fetchall()}


def _against_sql(spark, folder, name, texts):
    """The rows of a query over these texts, and those of its SQL."""
    import duckdb

    import __spark_entry__ as entry

    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)],
                          "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    con = duckdb.connect()
    for table in ("documents", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    sql = con.sql(entry.oracle_sql()[name])
    return ({tuple(r) for r in entry.queries()[name](spark, str(folder)).select(*sql.columns).collect()}, set(sql.fetchall()))


def test_fifteen_characters_of_a_reference_are_as_written(spark, tmp_path):
    # "n osmente ññ." has 13, and 15 with its accents apart; "n letters alike " ends in an n, not in half a ñ.
    texts = [f"word {i} of a longer text" for i in range(60)]
    texts[7], texts[8] = "Que jación osmente ññ.", "Que jación osmente ññññ."
    texts[12], texts[13], texts[14] = "Before: letters alike ñ and so on", "Before: letters alike n", None
    got, want = _against_sql(spark, tmp_path, "j30_resolve_references", texts)
    assert got == want and want


_ODD = ["", " \t\n ", None, "one two\n\t\nthree\n\n\n \nfour", "a <!-- not\n\nleft out --> b", "a\x0bb\x0b\x0bc\x85\x85d  e", "a\r\rb\r\n\r\nc\fd",
        " x y ", "x\n\n ", "　", "y z “q” – r", "y z 'q' - r", "one two three four five six seven", "ONE two  three four\nfive six eight"]


def _odd_texts(n=260):
    rng = random.Random(4)
    made = ["".join(rng.choice(["a", "B", "ñ", "7", ".", " ", "\n", "\t", "\r", "\f", "\x0b", " ", " ", "<!--", "-->", "\n\n", "’", "–"])
                    for _ in range(rng.choice((0, 1, 2, 4, 12, 60)))) for _ in range(n - len(_ODD))]
    texts = _ODD + made
    for i in range(20, n, 3):  # what x10 asks of a document stands 20 further on
        texts[i] = (texts[i - 20] or "")[rng.randint(0, 3):]
    return texts


def test_lengths_of_odd_texts_are_as_in_sql(spark, tmp_path):
    got, want = _against_sql(spark, tmp_path, "f23_length_rule", _odd_texts())
    assert got == want and (0, 1, 0, None) in want and (2, None, None, None) in want


def test_odd_claims_are_quoted_as_in_sql(spark, tmp_path):
    got, want = _against_sql(spark, tmp_path, "x10_quoted_in", _odd_texts())
    assert got == want and len({quoted for _, quoted in want}) == 3


def test_a_text_is_not_moved_to_hold_a_name_against_it(spark):
    from gaugeworks.operators import occurrence

    period, odd = "Annt " * 300, "Annt " * 150 + "Anxt " + "Annt " * 149
    held = [("k", 1, period), ("k", 2, odd), ("k", 3, "é" + odd), ("l", 1, period)]
    names = [period, odd, odd[5:], period[3:900], odd[700:800], odd[700:755] + "Annt " * 3 + "A", "A", "Anxt ", period + "A"]
    found = occurrence.found_in(spark.createDataFrame([("k", n) for n in names], "at string, path string"),
                                spark.createDataFrame(held, "at string, number int, text string"), "at", text_id="number")
    assert sorted((r.path, r.number) for r in found.collect()) == sorted((n, i) for n in names for k, i, t in held if k == "k" and n in t)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Contains(text" not in plan and "_met(text" in plan


def test_signatures_are_moved_as_strings_and_meet_others_only(spark):
    body = ["S1x alpha beta", "S1x alpha beta gamma", "alpha beta S1x", "S1x", "alpha beta", "", "S2x, S1x alpha beta delta"]
    made = [("t", i, b, 5, "completion", "user facing") for i, b in enumerate(body)] + [(None, 9, body[0], 5, "completion", "user facing")]
    lines = spark.createDataFrame(made, "task_id string, line_no bigint, criteria string, weight int, category string, place string")
    found = criteria.containment_pairs(lines)
    assert {tuple(r) for r in found.collect()} == {
        ("t", 0, 2, 1), ("t", 0, 1, 1), ("t", 0, 6, 1), ("t", 2, 6, 1)}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "array_except(marks#" not in plan and "NOT (sid#" in plan
