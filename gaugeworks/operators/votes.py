"""Checked statements: merged over readings, put to a blind vote, and what it comes to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gaugeworks import fixed
from gaugeworks.functions import text as tx
from gaugeworks.operators.criteria import folded_lines
from gaugeworks.operators.evidence import quotes_found
from gaugeworks.operators.occurrence import found_in
from gaugeworks.session import cut_lineage


def statement_id(file_norm: Column, quote_norm: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws("|", file_norm, quote_norm), 256), 1, 16)


def is_flagged() -> Column:
    """Held inaccurate with high confidence, settled by a check, and said why."""
    filled = lambda c: F.trim(F.coalesce(c, F.lit(""))) != ""
    return ((F.col("reading") == "inaccurate") & (F.col("confidence") == "high")
            & filled("check") & filled("what_is_wrong"))


def merged_statements(statements: DataFrame) -> DataFrame:
    """One row per statement: a flagged reading wins, the first otherwise; references united."""
    flagged = statements.withColumn("flagged", is_flagged())
    place = F.struct(~F.col("flagged"), "reading_no")
    held = flagged.groupBy("task_id", "statement_id").agg(
        F.min_by(F.struct("file", "quote", "reading", "flagged"), place).alias("s"))
    refs = (flagged.select("task_id", "statement_id", F.explode("bears_on").alias("ref"))
            .groupBy("task_id", "statement_id").agg(F.array_sort(F.collect_set("ref")).alias("bears_on")))
    return held.join(refs, ["task_id", "statement_id"], "left").select(
        "task_id", "statement_id", "s.*", F.coalesce("bears_on", F.array().cast("array<string>"))
        .alias("bears_on"))


def ballots(statements: DataFrame, seed: str = "") -> DataFrame:
    """Flagged statements with as many cleared ones, at least one, in an order the seed fixes.

    Places are ranks by digest; a rank under a limit is cut on the map side.
    """
    from pyspark.sql import Window

    flags = statements.groupBy("task_id").agg(F.count_if("flagged").alias("_n")).where("_n > 0")
    order = F.sha2(F.concat_ws("|", F.lit(seed), "task_id", "statement_id"), 256)
    ranked = statements.where("NOT flagged").withColumn("_rank", F.row_number().over(
        Window.partitionBy("task_id").orderBy("statement_id")))
    decoys = (ranked.join(flags, "task_id").where(F.col("_rank") <= F.greatest(F.lit(1), F.col("_n")))
              .drop("_rank", "_n"))
    pool = statements.where("flagged").unionByName(decoys)
    return pool.withColumn("place", F.row_number().over(
        Window.partitionBy("task_id").orderBy(order, "statement_id")))


def filled_votes(ballot: DataFrame, slots: list[str], votes: DataFrame) -> DataFrame:
    """One vote per ballot row and slot; a row nobody gave and an odd verdict cannot tell.

    `votes` is (task_id, statement_id, slot, verdict). Slots are a short fixed list.
    """
    spread = ballot.select("task_id", "statement_id", "flagged",
                           F.explode(F.array(*[F.lit(s) for s in slots])).alias("slot"))
    cast = (votes.groupBy("task_id", "statement_id", "slot")
            .agg(F.max_by("verdict", "vote_no").alias("verdict")))
    verdict = F.regexp_replace(F.lower(F.trim("verdict")), r"\s+", "_")
    return (spread.join(cast, ["task_id", "statement_id", "slot"], "left")
            .withColumn("verdict", F.when(verdict.isin(*fixed.VOTES), verdict).otherwise("cannot_tell")))


def vote_outcome(filled: DataFrame, answered: DataFrame, slots: list[str]) -> DataFrame:
    """A flagged statement is confirmed where every slot answered and all say inaccurate.

    `answered` is (task_id, slot) of the slots that voted at all.
    """
    present = answered.select("task_id", "slot").distinct().groupBy("task_id").agg(
        F.count("*").alias("_slots"))
    said = filled.groupBy("task_id", "statement_id").agg(
        F.first("flagged").alias("flagged"),
        F.bool_and(F.col("verdict") == "inaccurate").alias("_all"),
        F.count_if(F.col("verdict") == "inaccurate").alias("called_inaccurate"))
    full = F.coalesce("_slots", F.lit(0)) == len(slots)
    return said.join(present, "task_id", "left").select(
        "task_id", "statement_id", "flagged", "called_inaccurate",
        F.when(F.col("flagged"), full & F.col("_all")).alias("confirmed"))


def decoys_called(outcome: DataFrame) -> DataFrame:
    return outcome.groupBy("task_id").agg(F.coalesce(F.sum(F.when(
        ~F.col("flagged"), F.col("called_inaccurate"))), F.lit(0).cast("bigint"))
        .alias("decoys_called_inaccurate"))


def consistency(statements: DataFrame, tasks: DataFrame) -> DataFrame:
    """FAIL where something graded rests on a confirmed error of the true answer, WARN where
    nothing does, PASS where there is none."""
    held = statements.where((F.col("file") == fixed.GROUND_TRUTH) & F.coalesce("confirmed", F.lit(False)))
    rests = F.exists("bears_on", lambda b: ~b.startswith(fixed.ANSWER))
    sums = held.groupBy("task_id").agg(
        F.count_distinct("statement_id").alias("confirmed_statements"),
        F.bool_or(rests).alias("_rests"))
    return tasks.join(sums, "task_id", "left").select(
        "task_id", F.coalesce("confirmed_statements", F.lit(0).cast("bigint")).alias("confirmed_statements"),
        F.when(F.coalesce("_rests", F.lit(False)), "FAIL").when(
            F.col("confirmed_statements") > 0, "WARN").otherwise("PASS").alias("verdict"))


def united_checks(first: DataFrame, second: DataFrame) -> DataFrame:
    """Flagged statements of both checks in one list, each under its check's name."""
    a = first.where("flagged").withColumn("check_name", F.lit("criteria check"))
    b = second.where("flagged").withColumn("check_name", F.lit("justification check"))
    return a.unionByName(b)


def place_of(value: Column) -> Column:
    """Where a statement is, in the one spelling kept; null where it names something else."""
    text = tx.strip(F.regexp_replace(value, "^`+|`+$", ""))
    low = tx.normalise(text, False)
    number = F.regexp_extract(low, r"^(?:criterion|line|#)?\s*(\d+)$", 1)
    rel = F.regexp_replace(
        text, "^(?:/workspace/|environment/workspace/|bundle/environment/workspace/)", "")
    return (F.when(low.isin(*fixed.SPELLINGS_OF_TRUTH), fixed.GROUND_TRUTH)
            .when(low.contains("justification"), fixed.JUSTIFICATION)
            .when(low.isin(*fixed.SPELLINGS_OF_PROMPT), fixed.PROMPT).when(low.isin(*fixed.SPELLINGS_OF_ANSWER), fixed.ANSWER)
            .when(number != "", F.concat(F.lit("criterion "), number))
            .when(low.startswith("test "), F.concat(F.lit("test "), tx.strip(F.substr(text, F.lit(6)))))
            .otherwise(rel))


def _lines_meant(references: DataFrame, lines: DataFrame) -> DataFrame:
    """(task_id, value, place): the criterion each reference (task_id, value) gives by number or by words.

    Fifteen characters or more that stand in a line, or in which a line stands; of more than six words the first
    six are looked for. The first line that fits counts.
    """
    asked = references.select("task_id", "value", tx.normalise(F.col("value")).alias("ref"), F.regexp_extract(
        tx.strip(F.col("value")), r"(?i)^(?:criterion|line|#)?\s*(\d+)$", 1).try_cast("int").alias("n"))
    numbered = asked.where("n IS NOT NULL").join(lines.select("task_id", "n"), ["task_id", "n"]).select("task_id", "value", "n")
    worded = cut_lineage(asked.where((F.col("n").isNull()) & (F.length("ref") >= fixed.RESOLVE_MIN_CHARS)).drop("n"))
    folded = folded_lines(lines).select("task_id", "n", "line").where("line <> ''")

    def opening(text: Column) -> Column:
        return F.array_join(F.slice(F.split(text, " "), 1, 6), " ")
    inside = found_in(worded.select("task_id", opening(F.col("ref")).alias("part")), folded.withColumnRenamed("line", "text"), "task_id", "part", "n")
    inside = worded.withColumn("part", opening(F.col("ref"))).join(inside, ["task_id", "part"]).select("task_id", "value", "n")
    heads = cut_lineage(folded.groupBy("task_id", opening(F.col("line")).alias("part")).agg(F.min("n").alias("n")))
    around = found_in(heads, worded.select("task_id", "value", F.col("ref").alias("text")), "task_id", "part", "value")
    around = heads.join(around, ["task_id", "part"]).select("task_id", "value", "n")
    return (numbered.unionByName(inside).unionByName(around).groupBy("task_id", "value").agg(F.min("n").alias("n"))
            .select("task_id", "value", F.concat(F.lit("criterion "), F.col("n").cast("string")).alias("place")))


def places_meant(values: DataFrame, lines: DataFrame, tests: DataFrame, files: DataFrame, graded: bool = False) -> DataFrame:
    """(task_id, value, place) of the distinct values (task_id, value) that name something of their task.

    `lines` is (task_id, n, criteria), `tests` (task_id, name), `files` (task_id, path). With `graded` a value
    names what something rests on: the justification, the answer, a test, or a criterion in its own words; the
    prompt, the truth and files are nothing graded. Otherwise it is where a statement stands, and only what
    begins like a criterion's number is one.
    """
    asked = cut_lineage(values.select("task_id", "value").where("trim(value) <> ''").distinct()
                        .withColumn("spelt", place_of(F.col("value"))).withColumn("bare", tx.strip(F.regexp_replace("value", "^`+|`+$", ""))))
    low = tx.normalise(F.col("bare"), False)
    kept = (fixed.JUSTIFICATION, fixed.ANSWER) if graded else (fixed.GROUND_TRUTH, fixed.JUSTIFICATION, fixed.PROMPT, fixed.ANSWER)
    spelt = F.when(low.startswith("the run's answer"), fixed.ANSWER).otherwise(F.col("spelt")) if graded else F.col("spelt")
    plain = asked.withColumn("spelt", spelt).where(F.col("spelt").isin(*kept)).select("task_id", "value", F.col("spelt").alias("place"))
    rest = asked.join(plain, ["task_id", "value"], "left_anti")
    named = tests.select("task_id", F.concat(F.lit("test "), "name").alias("place")).distinct()
    by_test = rest.withColumn("place", F.when(F.col("spelt").startswith("test "), F.col("spelt")).otherwise(
        F.concat(F.lit("test "), "bare"))).join(named, ["task_id", "place"], "left_semi").select("task_id", "value", "place")
    rest = rest.join(by_test, ["task_id", "value"], "left_anti").where(~low.startswith("test "))
    numbered = low.rlike("^(?:criterion|line|#|[0-9]+$)")
    by_line = _lines_meant(rest if graded else rest.where(numbered), lines)
    out = plain.unionByName(by_test).unionByName(by_line)
    if graded:
        return out
    by_file = rest.where(~numbered).join(files.select("task_id", F.col("path").alias("spelt")).distinct(), ["task_id", "spelt"], "left_semi")
    return out.unionByName(by_file.select("task_id", "value", F.col("spelt").alias("place")))


def read_statements(raw: DataFrame, texts: DataFrame, lines: DataFrame, tests: DataFrame,
                    files: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(kept, dropped, unmet) of statements: a known reading, a real place, the quote in its text.

    `raw` is (task_id, statement_no, file, quote, reading, kind, bears_on, ...), `texts` (task_id, place, text)
    with the texts of the truth, justification, prompt and answer, of "tests" and "workspace", and of files by
    path. A kept statement has its place, a kind (an inaccurate one without a known kind is a "statement") and
    the places its bears_on name; `unmet` (task_id, statement_no, value) are those that name nothing graded.
    Each quotation is searched once; no text is joined to a statement.
    """
    ids = ["task_id", "statement_no"]
    quote = F.regexp_replace(tx.strip(F.col("quote")), '^["“”]+|["“”]+$', "")
    lines = cut_lineage(folded_lines(lines).select("task_id", "n", "line"))
    shaped = cut_lineage(raw.withColumn("reading", tx.normalise(F.col("reading"))).withColumn("_quote", tx.normalise(quote)))
    meant = places_meant(shaped.select("task_id", F.col("file").alias("value")), lines, tests, files)
    placed = cut_lineage(shaped.join(meant.withColumnRenamed("value", "file"), ["task_id", "file"], "left"))
    line = F.col("place").startswith("criterion ")
    known = F.col("place").isin(fixed.GROUND_TRUTH, fixed.JUSTIFICATION, fixed.PROMPT, fixed.ANSWER)
    read_at = F.when(line | known, F.array("place")).when(F.col("place").startswith("test "), F.array(F.lit("tests"))).otherwise(
        F.array(F.lit("workspace"), F.col("place")))
    asked = cut_lineage(placed.where("place IS NOT NULL").select(*ids, F.explode(read_at).alias("place"), F.col("_quote").alias("quote")))
    every = cut_lineage(texts.select("task_id", "place", tx.normalise(F.col("text")).alias("text"))).unionByName(lines.select(
        "task_id", F.concat(F.lit("criterion "), F.col("n").cast("string")).alias("place"), F.col("line").alias("text")))
    there = asked.join(quotes_found(asked, every), ["task_id", "place", "quote"], "left_semi").select(*ids).distinct().withColumn("_there", F.lit(True))
    why = (F.when(~F.coalesce(F.col("reading").isin(*fixed.READINGS), F.lit(False)), "no reading")
           .when(F.col("place").isNull() | (F.col("_quote") == ""), "not somewhere in this task")
           .when(F.col("_there").isNull(), "words not there"))
    judged = cut_lineage(placed.join(there, ids, "left").withColumn("why", why).drop("_there", "_quote"))
    kind = tx.normalise(F.col("kind"), False)
    kind = F.when(kind.isin(*fixed.STATEMENT_KINDS), kind).when(F.col("reading") == "inaccurate", "statement").otherwise("")
    bears = judged.where("why IS NULL").select(*ids, F.posexplode("bears_on").alias("_at", "value"))
    refs = places_meant(bears, lines, tests, files, graded=True)
    met = cut_lineage(bears.join(refs, ["task_id", "value"], "left"))
    # At most the entries of one statement; the first of equal places counts.
    rests = (met.where("place IS NOT NULL").groupBy(*ids, "place").agg(F.min("_at").alias("_at")).groupBy(*ids)
             .agg(F.transform(F.array_sort(F.collect_list(F.struct("_at", "place"))), lambda x: x.place).alias("bears_on")))
    kept = (judged.where("why IS NULL").drop("why", "bears_on").withColumn("kind", kind).join(rests, ids, "left")
            .withColumn("bears_on", F.coalesce("bears_on", F.array().cast("array<string>"))))
    return kept, judged.where("why IS NOT NULL"), met.where("place IS NULL AND trim(value) <> ''").select(*ids, "value")
