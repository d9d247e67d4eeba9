"""What a task's files weigh, what they are called, and how the prompt speaks of them.

Files are (task_id, path, bytes, n_chars, required).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from gaugeworks import fixed
from gaugeworks.functions import text as tx
from gaugeworks.functions.tokens import estimate_tokens
from gaugeworks.operators.occurrence import names_present


def file_tokens(path: Column, n_chars: Column) -> Column:
    """A file's tokens; a table is queried rather than read and counts up to a cap."""
    whole = estimate_tokens(n_chars)
    return F.when(tx.suffix(path).isin(*fixed.TABULAR_SUFFIXES), F.least(
        whole, F.lit(fixed.TABULAR_CAP_TOKENS))).otherwise(whole)


def material_estimate(files: DataFrame) -> DataFrame:
    tokens = file_tokens(F.col("path"), F.col("n_chars"))
    return files.groupBy("task_id").agg(
        F.sum(tokens).alias("material_tokens"),
        F.coalesce(F.sum(F.when(F.col("required"), tokens)), F.lit(0).cast("bigint")).alias("required_tokens"),
        F.bool_or("required").alias("has_required"))


def workspace_size(files: DataFrame, heavy_mb: int = fixed.HEAVY_WORKSPACE_MB) -> DataFrame:
    """Bytes of each workspace, whether it is heavy, and its three largest files."""
    totals = files.groupBy("task_id").agg(F.sum("bytes").alias("total_bytes"), F.count("*").alias("files"))
    order = Window.partitionBy("task_id").orderBy(F.desc("bytes"), F.desc("path"))
    top = (files.withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") <= 3)
           .groupBy("task_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_rn", "path"))),
                                                            lambda s: s["path"]), ", ").alias("largest")))
    return totals.join(top, "task_id").withColumn(
        "heavy", F.col("total_bytes") > heavy_mb * 1_000_000)


def answer_named_files(files: DataFrame) -> DataFrame:
    """Files whose own name suggests that the answer was uploaded with the material."""
    return files.where(tx.base_name(F.col("path")).rlike(fixed.ANSWER_FILE_NAME)).select("task_id", "path")


def listing(files: DataFrame) -> DataFrame:
    """Files the model sees: placeholders left out."""
    return files.where(tx.base_name(F.col("path")) != fixed.PLACEHOLDER_FILE)


def prompt_shape(prompts: DataFrame, files: DataFrame) -> DataFrame:
    """Prompts that are empty or very short, read like a specification, or name files.

    A file is named where its whole path is in the prompt.
    """
    named = (names_present(files, prompts.select("task_id", F.col("prompt").alias("text")), "task_id")
             .groupBy("task_id").agg(F.count("*").alias("files_named")))
    size = F.length("prompt")
    return prompts.join(named, "task_id", "left").select(
        "task_id", (size == 0).alias("empty"),
        ((size > 0) & (size < fixed.SHORT_PROMPT_CHARS)).alias("very_short"),
        F.col("prompt").rlike(fixed.SPEC_SHAPE).alias("reads_like_specification"),
        F.coalesce("files_named", F.lit(0).cast("bigint")).alias("files_named"))


def suffix_findings(files: DataFrame, packages: DataFrame) -> DataFrame:
    """Suffixes nothing is known to open, and packages a suffix needs that are not present."""
    seen = files.select("task_id", tx.suffix(F.col("path")).alias("suffix")).where("suffix <> ''").distinct()
    table = F.create_map(*[F.lit(x) for kv in fixed.SUFFIX_PACKAGE.items() for x in kv])
    typed = seen.withColumn("package", F.try_element_at(table, F.col("suffix")))
    have = packages.select("task_id", F.lower(F.get(F.split("spec", "=", 2), 0)).alias("_p")).distinct()
    wanted = (typed.where("package IS NOT NULL").withColumn("_p", F.lower("package"))
              .join(have, ["task_id", "_p"], "left_anti")
              .select("task_id", "suffix", F.lit("needs a package").alias("problem"), "package"))
    unknown = typed.where(F.col("package").isNull() & ~F.col("suffix").isin(*fixed.READABLE_SUFFIXES))
    return wanted.unionByName(unknown.select("task_id", "suffix", F.lit("not recognised").alias("problem"), "package"))


def accounts_differ(files: DataFrame, prose: DataFrame) -> DataFrame:
    """Required files the prose calls misleading, and distractors it never mentions.

    `prose` is one (task_id, text) row a task. Reliable saying a file is mentioned.
    """
    said = files.join(prose.select("task_id", "text"), "task_id")
    named = tx.mentions(F.col("text"), F.col("path"))
    side = F.when(F.col("required") & named, "required_called_misleading").when(
        ~F.col("required") & ~named, "distractor_not_mentioned")
    return said.select("task_id", "path", side.alias("side")).where("side IS NOT NULL")


def shown_outputs(files: DataFrame, budget: int = fixed.OUTPUT_CHAR_BUDGET, salts: int = 64) -> DataFrame:
    """How much of each produced file's text fits a run's budget: new files first, then by path.

    `files` is (run_id, path, state, n_chars). Text beyond the budget is cut, and
    files after it are listed without text. A file with text takes at least one
    character, so of every salted share of a run only its first `budget` such
    files can start within it; those alone are summed in order, at most `budget`
    times `salts` rows, and every other file is listed as it is.
    """
    order = (F.col("state") != "new", F.col("path"))
    share = Window.partitionBy("run_id", F.pmod(F.hash("path"), F.lit(salts))).orderBy(*order)
    ranked = files.where("n_chars > 0").withColumn("_rn", F.row_number().over(share))
    running = Window.partitionBy("run_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n_chars").over(running), F.lit(0))
    first = ranked.where(F.col("_rn") <= budget).withColumn("_left", F.greatest(F.lit(0), budget - before))
    rest = ranked.where(F.col("_rn") > budget).withColumn("_left", F.lit(0).cast("bigint"))
    empty = files.where("n_chars = 0").select("*", F.lit(0).alias("_rn"), F.lit(0).cast("bigint").alias("_left"))
    return first.unionByName(rest).unionByName(empty).select(
        "run_id", "path", "state", "n_chars", F.least("_left", "n_chars").alias("shown_chars"),
        (F.col("n_chars") > F.col("_left")).alias("cut"))


def paths_nobody_has(tests: DataFrame, files: DataFrame, prompts: DataFrame) -> DataFrame:
    """Paths in test sources that no file, manifest or prompt of the task has.

    A listed file also answers for its own endings after a slash.
    """
    literal = F.transform(F.regexp_extract_all("source", F.lit("[\"']([^\"'\\n]+)[\"']"), F.lit(1)),
                          lambda s: F.regexp_replace(tx.strip(s), r"^[./]+", ""))
    asked = tests.select("task_id", F.explode(F.array_distinct(F.filter(
        literal, lambda s: s.rlike(r"(?U)^[\w./-]+\.[A-Za-z0-9]{1,8}$")))).alias("path")).distinct()
    parts = F.split("path", "/")
    ends = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(
        F.slice(parts, i, F.size(parts)), "/"))
    known = files.select("task_id", F.explode(ends).alias("path")).distinct()
    left = asked.join(known, ["task_id", "path"], "left_anti")
    seen = names_present(left, prompts.select("task_id", F.col("prompt").alias("text")), "task_id")
    return left.join(seen, ["task_id", "path"], "left_anti")


def latest_attempt(attempts: DataFrame) -> DataFrame:
    """The attempt of each job every reader uses: the newest transcript, ties by path."""
    return attempts.groupBy("job").agg(F.max_by(
        "attempt", F.struct("modified", "path")).alias("attempt"), F.count_distinct("attempt").alias("attempts"))
