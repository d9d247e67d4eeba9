"""Where the figures and files of an answer come from.

Inputs are (run_id, text) rows, in as many rows a run as there are. Figures and
paths become rows, deduplicated on (run_id, token) before any join, so the join
key is spread even where one run holds much of the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from gaugeworks import fixed
from gaugeworks.functions import text as tx
from gaugeworks.functions.numbers import interesting, numbers_in
from gaugeworks.operators.occurrence import names_present
from gaugeworks.session import cut_lineage

KEYS = ["run_id", "value"]


def figure_rows(rows: DataFrame) -> DataFrame:
    """Distinct canonical numbers of each run."""
    return rows.select("run_id", F.explode(numbers_in(F.col("text"))).alias("value")).distinct()


def figures_by_source(*sources: DataFrame) -> DataFrame:
    """(run_id, value, sources): each figure of a run once, bit k of `sources` set where source k has it.

    A source is (run_id, text). Each text is parsed once, and what was one semi or anti join a source is
    one aggregation combined on the map side and a test of bits.
    """
    tagged = None
    for k, rows in enumerate(sources):
        one = rows.select("run_id", "text", F.lit(1 << k).alias("bit"))
        tagged = one if tagged is None else tagged.unionByName(one)
    return tagged_figures(tagged)


def tagged_figures(rows: DataFrame) -> DataFrame:
    """(run_id, value, sources) of (run_id, text, bit)."""
    return (rows.select("run_id", "bit", F.explode(numbers_in(F.col("text"))).alias("value"))
            .groupBy("run_id", "value").agg(F.bit_or("bit").alias("sources")))


def _in_all_but(figures: DataFrame, within: int, outside: int) -> DataFrame:
    """The figures worth a check that every source of `within` has and none of `outside`, both bits."""
    return figures.where(F.col("sources").bitwiseAND(F.lit(within | outside)) == within).where(
        interesting(F.col("value"))).select(*KEYS)


def union_of_figures(*corpora: DataFrame) -> DataFrame:
    out = corpora[0].select("run_id", "text")
    for c in corpora[1:]:
        out = out.unionByName(c.select("run_id", "text"))
    return figure_rows(out)


def first_per_run(findings: DataFrame, *order, k: int = fixed.FINDINGS_PER_CHECK) -> DataFrame:
    """The first `k` findings of each run and check.

    A row number under a limit is cut to `k` rows per group on the map side, so a
    large group does not reach one task.
    """
    keys = [c for c in ("run_id", "check") if c in findings.columns]
    window = Window.partitionBy(*keys).orderBy(*order)
    return (findings.withColumn("_rn", F.row_number().over(window)).where(F.col("_rn") <= k)
            .drop("_rn"))


def unsourced_figures(answer: DataFrame, *sources: DataFrame) -> DataFrame:
    """Figures of the answer that no source has."""
    return _in_all_but(figures_by_source(answer, *sources), 1, (2 << len(sources)) - 2)


def missing_from_answer(truth: DataFrame, answer: DataFrame) -> DataFrame:
    """Figures of the true answer that were never stated."""
    return _in_all_but(figures_by_source(truth, answer), 1, 2)


def planted_figures(distractors: DataFrame, answer: DataFrame, truth: DataFrame) -> DataFrame:
    """Planted wrong figures that were stated, those also right left out."""
    return _in_all_but(figures_by_source(distractors, answer, truth), 3, 4)


def looked_up_figures(truth: DataFrame, answer: DataFrame, results: DataFrame, requests: DataFrame) -> DataFrame:
    """Figures of the true answer, stated by the run, that only a web page gave it.

    `results` is (run_id, call_id, text), `requests` names the calls (run_id, call_id) that went to the web.
    """
    web = requests.select("run_id", "call_id", F.lit(4).alias("bit")).distinct()
    came = results.select("run_id", "call_id", "text").join(web, ["run_id", "call_id"], "left").select(
        "run_id", "text", F.coalesce("bit", F.lit(8)).alias("bit"))
    rows = truth.select("run_id", "text", F.lit(1).alias("bit")).unionByName(
        answer.select("run_id", "text", F.lit(2).alias("bit"))).unionByName(came)
    return _in_all_but(tagged_figures(rows), 7, 8)


def cited_paths(rows: DataFrame) -> DataFrame:
    """Distinct paths of each run."""
    return rows.select("run_id", F.explode(tx.paths_in(F.col("text"))).alias("path")).distinct()


def _occurs(paths: DataFrame, texts: DataFrame, how: str) -> DataFrame:
    """Paths that occur in a text (or do not), whole or by their last part."""
    asked = paths.select("run_id", "path", F.explode(F.array_distinct(F.array(
        "path", tx.base_name(F.col("path"))))).alias("_seen"))
    hit = asked.join(names_present(asked, texts, "run_id", "_seen"), ["run_id", "_seen"], "left_semi").select("run_id", "path").distinct()
    return paths.join(hit, ["run_id", "path"], how)


def _tails(files: DataFrame) -> DataFrame:
    """A file's name and every ending of it after a blank, underscore or dash."""
    name = tx.base_name(F.col("path"))
    ends = F.transform(F.sequence(F.lit(1), F.length(name)), lambda i: F.when(
        (i == 1) | name.substr(i - 1, F.lit(1)).isin(" ", "_", "-"),
        name.substr(i, F.length(name))))
    return files.select("run_id", F.explode(F.array_compact(ends)).alias("_tail")).distinct()


def unknown_paths(answer: DataFrame, files: DataFrame, observed: DataFrame,
                  actions: DataFrame) -> DataFrame:
    """Cited files that exist nowhere, with `level` strong, or check where a command names them.

    A name the environment reported back is dropped. A citation that completes a
    real name after a blank, an underscore or a dash counts as that name.
    """
    cited = cited_paths(answer).where(tx.suffix(F.col("path")).isin(*fixed.CITABLE_SUFFIXES))
    unknown = (cited.join(files.select("run_id", "path").distinct(), ["run_id", "path"], "left_anti")
               .withColumn("_tail", tx.base_name(F.col("path")))
               .join(_tails(files), ["run_id", "_tail"], "left_anti").drop("_tail"))
    # A few names, each read several times.
    unseen = cut_lineage(_occurs(cut_lineage(unknown), observed, "left_anti"))
    ran = _occurs(unseen, actions, "left_semi").select("run_id", "path", F.lit("check").alias("_ran"))
    return unseen.join(ran, ["run_id", "path"], "left").withColumn(
        "level", F.coalesce("_ran", F.lit("strong"))).drop("_ran")


def claimed_files(answer: DataFrame) -> DataFrame:
    """Paths within 80 characters of a writing verb, inside one sentence."""
    verb = F.regexp_extract(F.col("s"), "(" + fixed.WROTE_VERB + ")", 1)
    after = F.col("s").substr(F.position(verb, F.col("s")) + F.length(verb), F.lit(80))
    return (answer.select("run_id", F.explode(tx.sentences(F.col("text"))).alias("s"))
            .where(F.col("s").rlike(fixed.WROTE_VERB))
            .select("run_id", F.explode(tx.paths_in(after)).alias("path")).distinct())


def unproduced_files(answer: DataFrame, produced: DataFrame, given: DataFrame,
                     transcript: DataFrame, collected: DataFrame) -> DataFrame:
    """Files the answer says it wrote that were neither produced, given nor mentioned.

    `collected` lists the runs whose files came back; of the others nothing is said.
    """
    known = produced.select("run_id", "path").unionByName(given.select("run_id", "path"))
    names = known.select("run_id", F.explode(F.array("path", tx.base_name(F.col("path"))))
                         .alias("_n")).distinct()
    claims = claimed_files(answer).join(collected.select("run_id").distinct(), "run_id", "left_semi")
    asked = claims.withColumn("_n", F.explode(F.array_distinct(F.array(
        "path", tx.base_name(F.col("path"))))))
    held = asked.join(names, ["run_id", "_n"], "left_semi").select("run_id", "path").distinct()
    left = claims.join(held, ["run_id", "path"], "left_anti")
    return _occurs(left, transcript, "left_anti")


def misleading_files_cited(distractors: DataFrame, files: DataFrame, answer: DataFrame) -> DataFrame:
    """Known files named among the distractors that the answer mentions."""
    named = cited_paths(distractors).join(
        files.select("run_id", "path").distinct(), ["run_id", "path"], "left_semi")
    return named.join(names_present(named, answer, "run_id"), ["run_id", "path"], "left_semi")


def uncovered(findings: DataFrame, criteria: DataFrame) -> DataFrame:
    """Findings with a figure or path that no criterion of the run names.

    `findings` is (run_id, subject, subject_kind, ...), `criteria` (run_id, text).
    """
    from gaugeworks.functions.numbers import canonical_number

    figures = figure_rows(criteria).withColumnRenamed("value", "_token")
    asked = findings.where("coalesce(subject, '') <> ''").withColumn("_token", F.when(
        F.col("subject_kind") == "figure", canonical_number(F.col("subject"))).otherwise(
        F.col("subject")))
    keys = ["run_id", "_token"]
    paths = asked.where("subject_kind = 'path'")
    left = (asked.where("subject_kind = 'figure'").join(figures, keys, "left_anti")
            .unionByName(paths.join(names_present(paths, criteria, "run_id", "_token"), keys, "left_anti")))
    return left.drop("_token")


def action_claims(answer: DataFrame) -> DataFrame:
    """First-person claims to have done something, with up to six anchors each."""
    claims = (answer.select("run_id", F.explode(tx.sentences(F.col("text"))).alias("sentence"))
              .where(F.col("sentence").rlike(fixed.ACTION)))
    tokens = F.regexp_extract_all("sentence", F.lit(fixed.ANCHOR), F.lit(0))
    letters = r"^\p{L}+$"
    kept = F.filter(tokens, lambda w: ~w.rlike(letters) | ((F.lower(w) == w) & (F.upper(w) != w)))
    return claims.select("run_id", "sentence",
                         F.lower(F.regexp_extract("sentence", fixed.ACTION, 1)).alias("verb"),
                         F.slice(kept, 1, 6).alias("anchors"))


def unmatched_claims(answer: DataFrame, transcript: DataFrame) -> DataFrame:
    """Action claims none of whose anchors is a word of the run's transcript.

    Anchors and transcript tokens meet on (run, token); a token counts with every
    ending stretch an anchor could be, so the test is the one on the whole text.
    """
    claims = action_claims(answer).distinct()
    tokens = F.array_distinct(F.regexp_extract_all("text", F.lit(r"(?U)[\w./-]{4,}"), F.lit(0)))
    words = transcript.select("run_id", F.explode(tokens).alias("_w")).distinct()
    asked = claims.withColumn("_w", F.explode("anchors"))
    matched = asked.join(words, ["run_id", "_w"], "left_semi").select("run_id", "sentence").distinct()
    rest = claims.join(matched, ["run_id", "sentence"], "left_anti")
    # Inside a longer token: only for the claims and lengths still open.
    lengths = asked.join(rest, ["run_id", "sentence"], "left_semi").select(
        "run_id", "sentence", "_w", F.length("_w").alias("_len")).distinct()
    open_lengths = lengths.select("run_id", "_len").distinct()
    pieces = (words.join(open_lengths, "run_id").where(F.length("_w") > F.col("_len"))
              .select("run_id", F.explode(F.transform(
                  F.sequence(F.lit(1), F.length("_w") - F.col("_len") + 1),
                  lambda i: F.col("_w").substr(i, F.col("_len")))).alias("_w")).distinct())
    inside = lengths.join(pieces, ["run_id", "_w"], "left_semi").select("run_id", "sentence").distinct()
    return rest.join(inside, ["run_id", "sentence"], "left_anti")


def suggestion_restates(suggested: DataFrame, written: DataFrame) -> DataFrame:
    """Suggested lines whose content words a written line of the run already has.

    A suggestion of n words restates a line when its words are a subset, or the
    Jaccard share is at least 0.6. Either way at least 0.6 n of them are shared, so
    one of its n - 0.6 n + 1 rarest is; only those are looked up.
    """
    mine = suggested.select("run_id", "suggestion_id",
                            F.array_sort(tx.content_words(F.col("text"))).alias("mine")).where(
        F.size("mine") > 0)
    bare = F.regexp_replace(F.col("text"), r"^\[[+-]?\d\]\s*", "")
    theirs = written.select("run_id", F.array_sort(tx.content_words(bare)).alias("theirs")).where(
        F.size("theirs") > 0).distinct()
    spread = (theirs.select("run_id", F.explode("theirs").alias("w"))
              .groupBy("run_id", "w").agg(F.count("*").alias("n")))
    keyed = (mine.withColumn("w", F.explode("mine")).join(spread, ["run_id", "w"], "left")
             .groupBy("run_id", "suggestion_id")
             .agg(F.first("mine").alias("mine"), F.array_sort(F.collect_list(F.struct(
                 F.coalesce("n", F.lit(0)).alias("n"), "w"))).alias("ranked")))
    prefix = F.greatest(F.lit(1), F.size("mine") - F.ceil(F.size("mine") * F.lit(0.6)).cast("int") + 1)
    probes = keyed.select("run_id", "suggestion_id", "mine", F.explode(F.slice(
        F.transform("ranked", lambda s: s["w"]), F.lit(1), prefix)).alias("w"))
    pool = theirs.withColumn("w", F.explode("theirs"))
    shared = F.size(F.array_intersect("mine", "theirs"))
    union = F.size("mine") + F.size("theirs") - shared
    hit = (shared == F.size("mine")) | (shared * 10 >= union * 6)
    return probes.join(pool, ["run_id", "w"]).where(hit).select("run_id", "suggestion_id").distinct()


def suggestion_against_answer(suggested: DataFrame, truth: DataFrame, traps: DataFrame) -> DataFrame:
    """Suggested negatives made only of what the true answer says, traps excepted."""
    mine = suggested.withColumn("mine", tx.content_words(F.col("text"))).where(F.size("mine") >= 3)
    said = truth.select("run_id", F.explode(tx.content_words(F.col("text"))).alias("w")).distinct()
    words = mine.select("run_id", "suggestion_id", F.explode("mine").alias("w"))
    outside = words.join(said, ["run_id", "w"], "left_anti").select("run_id", "suggestion_id").distinct()
    figures = mine.select("run_id", "suggestion_id", F.explode(numbers_in(F.col("text"))).alias("value"))
    trapped = figures.join(figure_rows(traps), KEYS, "left_semi").select(
        "run_id", "suggestion_id").distinct()
    keys = ["run_id", "suggestion_id"]
    return (mine.select(*keys).join(outside, keys, "left_anti").join(trapped, keys, "left_anti"))
