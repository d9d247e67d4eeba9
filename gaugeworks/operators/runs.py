"""Runs set against the runs before them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from gaugeworks import fixed
from gaugeworks.functions.text import words_changed
from gaugeworks.operators.series import MAX_ROWS, longest_series, number_rows, over_positions


# Words of a prompt that is met by its shortened forms; there are about half the square of that many.
SHORT_PROMPT = 48
_KEYS = ["workspace_sha256", "environment_sha256"]


def _words(prompt: str = "prompt") -> Column:
    return F.filter(F.split(prompt, r"\s+"), lambda w: w != "")


def _forms(df: DataFrame, rows: list[str], asked: bool) -> DataFrame:
    """(rows, form, words): digests of each prompt without up to two of its words, and what meeting there costs.

    A digest says how many words each side leaves out, and in some the places they stood at in what is left:
    one word for another has one place on both sides and costs one, elsewhere each word left out costs one.
    """
    n = F.size("_w")
    places = F.transform(F.sequence(F.lit(0), n), lambda i: i - 1)  # -1: nothing left out
    pairs = F.flatten(F.transform(places, lambda p: F.transform(
        F.filter(places, lambda q: (q > p) | ((q == -1) & (p == -1))), lambda q: F.struct(p.alias("p"), q.alias("q")))))
    # Prompts are short and become hundreds of rows each: a few megabytes are work for all cores.
    spread = df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism, "prompt")
    out = spread.where("workspace_sha256 IS NOT NULL AND environment_sha256 IS NOT NULL").withColumn("_w", _words()).select(
        *_KEYS, *rows, "_w", F.explode(pairs).alias("_pq"))
    p, q = F.col("_pq.p"), F.col("_pq.q")
    rest = F.array_join(F.filter("_w", lambda w, i: (i != p) & (i != q)), " ")
    # Places in what is left; a single word left out is q.
    first, second = p.cast("string"), (q - 1).cast("string")

    def kind(mine: int, theirs: int, words: int, *at: Column) -> Column:
        x, y = (mine, theirs) if asked else (theirs, mine)
        return F.struct(F.concat_ws("@", F.lit(f"{x}{y}"), *at).alias("kind"), F.lit(words).cast("bigint").alias("words"))
    kinds = (F.when(q == -1, F.array(kind(0, 0, 0), kind(0, 1, 1), kind(0, 2, 2)))
             .when(p == -1, F.array(kind(1, 0, 1), kind(1, 1, 2), kind(1, 1, 1, q.cast("string")), kind(1, 2, 2, q.cast("string"))))
             .otherwise(F.array(kind(2, 0, 2), kind(2, 2, 2, first, second), kind(2, 1, 2, first), kind(2, 1, 2, second))))
    return out.select(*_KEYS, *rows, rest.alias("_rest"), F.explode(F.array_distinct(kinds)).alias("_k")).select(
        *rows, F.unhex(F.md5(F.concat_ws("\1", *_KEYS, "_k.kind", "_rest"))).alias("form"), "_k.words")


def _met_by_forms(new: DataFrame, old: DataFrame) -> DataFrame:
    """(keys, _now, words, started, run_id): for each prompt the first earlier run of the fewest words apart, two at most.

    Earlier runs of one form are folded before they meet, so prompts that all say nearly the same never meet pair by pair.
    """
    digest = F.unhex(F.md5(F.concat_ws("\1", *_KEYS, "prompt"))).alias("_id")
    mine = _forms(new.select("*", digest), ["_id"], True)
    theirs = _forms(old, ["started", "run_id"], False).groupBy("form").agg(F.min(F.struct("started", "run_id")).alias("m"))
    met = mine.join(theirs, "form").groupBy("_id").agg(F.min(F.struct("words", "m.started", "m.run_id")).alias("m"))
    return new.select(*_KEYS, F.col("prompt").alias("_now"), digest).join(met, "_id").select(
        *_KEYS, "_now", "m.words", "m.started", "m.run_id")


def _met_by_stretches(new: DataFrame, old: DataFrame, most: int) -> DataFrame:
    """The same by a stretch both prompts have: cut in most + 1 equal ones, two that close share one."""
    def pieces(df: DataFrame, spread: bool) -> DataFrame:
        df = df.withColumn("_words", _words()).withColumn("_n", F.size("_words"))
        lengths = (F.sequence(F.greatest(F.lit(0), F.col("_n") - most), F.col("_n") + most)
                   if spread else F.array("_n"))
        df = df.withColumn("_len", F.explode(lengths))
        # Stretches of the prompt of length _len, as this prompt has them: shifted by
        # the words gained or lost before the stretch.
        parts = []
        for i in range(most + 1):
            size = F.floor((F.col("_len") + i) / (most + 1)).cast("int")
            start = sum((F.floor((F.col("_len") + j) / (most + 1)).cast("int") for j in range(i)),
                        F.lit(0))
            shifts = range(-most, most + 1) if spread else (0,)
            for s in shifts:
                ok = (start + s >= 0) & (start + s + size <= F.col("_n"))
                at = F.greatest(F.lit(1), start + s + 1)
                parts.append(F.when(ok, F.struct(F.lit(i).alias("i"), F.md5(F.array_join(F.slice(
                    "_words", at, F.greatest(size, F.lit(0))), " ")).alias("stretch"))))
        return df.withColumn("_p", F.explode(F.array_distinct(F.array_compact(F.array(*parts))))).select(
            *_KEYS, "_len", "_p.i", "_p.stretch", "prompt", *[c for c in ("run_id", "started") if c in df.columns])

    a = pieces(new, True).select(*_KEYS, "_len", "i", "stretch", F.col("prompt").alias("_now"))
    pairs = a.join(pieces(old, False), [*_KEYS, "_len", "i", "stretch"]).select(
        *_KEYS, "_now", "prompt", "run_id", "started").distinct()
    return (pairs.withColumn("words", words_changed(F.col("prompt"), F.col("_now"), most)).where("words IS NOT NULL")
            .select(*_KEYS, "_now", "words", "started", "run_id"))


def near_identical(now: DataFrame, earlier: DataFrame,
                   most: int = fixed.MINOR_PROMPT_WORDS) -> DataFrame:
    """The earlier counted run each run would all but repeat: fewest words changed, then first.

    Same files and environment by digest, at most `most` words apart. Equal prompts are
    settled first and compared with nothing else. The others meet by their forms without up to
    two words, long ones, and with `most` above two, by a stretch they share.
    """
    keys = _KEYS
    old = (earlier.where("counted AND prompt IS NOT NULL").groupBy(*keys, "prompt")
           .agg(F.min(F.struct("started", "run_id")).alias("_first"))
           .select(*keys, "prompt", F.col("_first.run_id").alias("run_id"),
                   F.col("_first.started").alias("started")))
    asked = now.select(*keys, "prompt").distinct()
    same = asked.join(old, [*keys, "prompt"]).select(
        *keys, F.col("prompt").alias("_now"), F.lit(0).cast("bigint").alias("words"), "started", "run_id")
    new = asked.where("prompt IS NOT NULL").join(old, [*keys, "prompt"], "left_anti")
    if most > 2:
        close = _met_by_stretches(new, old, most).unionByName(same)
    else:
        n = F.size(_words())
        close = (_met_by_forms(new.where(n <= SHORT_PROMPT), old.where(n <= SHORT_PROMPT + most)).where(F.col("words") <= most)
                 .unionByName(_met_by_stretches(new.where(n > SHORT_PROMPT), old.where(n > SHORT_PROMPT - most), most)).unionByName(same))
    best = close.groupBy(*keys, "_now").agg(F.min(F.struct("words", "started", "run_id")).alias("m"))
    return now.join(best.select(*keys, F.col("_now").alias("prompt"), F.col("m.run_id").alias("like_run"),
                                F.col("m.words").alias("words")), [*keys, "prompt"])


def answer_changed_between(runs: DataFrame, most: int = fixed.MINOR_PROMPT_WORDS,
                           max_rows: int = MAX_ROWS) -> DataFrame:
    """Successive runs of a task with the sealed answer changed, the files the same
    and at most `most` words of the prompt changed."""
    longest = longest_series(runs, ["task_id"])
    placed = number_rows(runs.where("sealed_sha256 IS NOT NULL"), ["task_id"], "started", "run_id",
                         max_rows, longest)
    names = ("run_id", "sealed_sha256", "workspace_sha256", "prompt")
    pairs = over_positions(placed, ["task_id"], {
        f"_{c}": (lambda w, c=c: F.lag(c).over(w)) for c in names}, before=1,
        max_rows=max_rows, longest=longest)
    moved = pairs.where("_sealed_sha256 <> sealed_sha256 AND _workspace_sha256 = workspace_sha256")
    return (moved.withColumn("words", words_changed(F.col("_prompt"), F.col("prompt"), most)).where("words IS NOT NULL")
            .select("task_id", F.col("_run_id").alias("from_run"), F.col("run_id").alias("to_run"), "words"))
