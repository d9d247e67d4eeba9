"""Replies, answers, calls and context use of runs.

`steps` is one row per step (run_id, turn, speaker, text, role, is_agent, is_own,
stop_reason), `calls` one per tool call (tool, argument, description, call_id) and
`results` one per tool result (call_id, text). Everything that can stay a row per step does; only a
run's replies are joined, into its answer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gaugeworks import fixed
from gaugeworks.functions import text as tx, variants as va
from gaugeworks.functions.tokens import token_band
from gaugeworks.operators.occurrence import names_present
from gaugeworks.sources.transcripts import is_agent


def replies(steps: DataFrame) -> DataFrame:
    """What the agent said at the end of each of its turns.

    The last message is always a reply; earlier ones are where their stop reason
    ends the turn. The last one is an aggregate, so no window sorts a run.
    """
    spoken = steps.where("is_own AND text <> ''").select("run_id", "turn", "text", "stop_reason")
    ends = F.col("stop_reason").isNotNull() & ~F.col("stop_reason").isin(*fixed.TURN_GOES_ON)
    last = spoken.groupBy("run_id").agg(F.max_by(
        F.struct("turn", "text", "stop_reason"), "turn").alias("s")).select("run_id", "s.*")
    return spoken.where(ends).unionByName(last.where(~F.coalesce(ends, F.lit(False)))).select(
        "run_id", "turn", "text")


def final_answer(steps: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """The answer of each run in order: an answer file where there is one, else its replies.

    Text after the final mark is taken, up to a second one. A run has one answer,
    however many turns it took: what its agent said at the ends of them.
    """
    ordered = F.array_sort(F.collect_list(F.struct("turn", "text")))
    out = (replies(steps).groupBy("run_id")
           .agg(F.array_join(F.transform(ordered, lambda s: s["text"]), fixed.REPLY_SEPARATOR)
                .alias("text")))
    if files is None:
        return out
    cut = F.when(F.col("text").contains(fixed.FINAL_MARK),
                 tx.strip(F.get(F.split(F.col("text"), fixed.FINAL_MARK), 1))).otherwise(
        tx.strip(F.col("text")))
    written = files.select("run_id", cut.alias("text")).where("text <> ''")
    return written.unionByName(out.join(written.select("run_id"), "run_id", "left_anti"))


def observed_rows(steps: DataFrame, results: DataFrame,
                  session_results: DataFrame | None = None) -> DataFrame:
    """Text that came back to the agent: other speakers, tool results, session results."""
    said = steps.where("NOT is_agent AND text <> ''").select("run_id", "text")
    back = results.select("run_id", tx.drop_encoded(F.col("text")).alias("text"))
    out = said.unionByName(back)
    return out if session_results is None else out.unionByName(
        session_results.select("run_id", "text"))


def action_rows(calls: DataFrame) -> DataFrame:
    """Every call as it was run."""
    return calls.select("run_id", F.concat_ws(" ", "tool", "argument").alias("text"))


def calls_with_results(calls: DataFrame, results: DataFrame) -> DataFrame:
    """Each call beside every result that answers it; calls without one keep a null.

    Results without an id answer no call; `unkeyed_results` keeps those apart.
    """
    answered = results.where("call_id <> ''").select(
        "run_id", "call_id", F.col("text").alias("result"))
    return calls.join(answered, ["run_id", "call_id"], "left")


def unkeyed_results(results: DataFrame) -> DataFrame:
    return results.where("call_id = ''")


def fragment_seen(rows: DataFrame, fragment: str) -> DataFrame:
    """Whether any text of a run contains a fragment; only a yes is reliable."""
    return rows.groupBy("run_id").agg(F.bool_or(F.col("text").contains(fragment)).alias("seen"))


def files_opened(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Files whose path or name occurs in a run's text; only a yes is reliable."""
    asked = files.select("run_id", "path", F.explode(F.array_distinct(F.array(
        "path", tx.base_name(F.col("path"))))).alias("_seen"))
    hits = asked.join(names_present(asked, rows, "run_id", "_seen"), ["run_id", "_seen"], "left_semi").select(
        "run_id", "path").distinct()
    return (files.join(hits.withColumn("opened", F.lit(True)), ["run_id", "path"], "left")
            .withColumn("opened", F.coalesce("opened", F.lit(False))))


# --- context --------------------------------------------------------------------

def prompt_size() -> Column:
    return (F.col("input_tokens") + F.col("cache_creation_input_tokens")
            + F.col("cache_read_input_tokens"))


def context_size(sessions: DataFrame) -> DataFrame:
    """Peak, first and added context of each run; null, not zero, where under two calls.

    The first call is the earliest by time, then by position in the log.
    """
    size = F.when(F.col("has_usage") & (prompt_size() > 0), prompt_size())
    sums = sessions.groupBy("run_id").agg(
        F.count(size).alias("calls"), F.max(size).alias("_peak"),
        F.min_by(size, F.when(size.isNotNull(), F.struct("timestamp", "position"))).alias("_first"))
    measured = F.col("calls") >= 2
    added = F.col("_peak") - F.col("_first")
    return sums.select(
        "run_id", "calls", measured.alias("measured"),
        F.when(measured, F.col("_peak")).alias("context_peak"),
        F.when(measured, F.col("_first")).alias("context_baseline"),
        F.when(measured, added).alias("context_added"),
        F.when(measured, added + fixed.HARNESS_ALLOWANCE).alias("context_reported")).withColumn(
        "context_band", token_band(F.col("context_reported")))


def token_totals(sessions: DataFrame) -> DataFrame:
    """Tokens by kind, a message counted once however many records it spans.

    The earliest record of a message stands for it; records without an id all
    count. Both aggregates combine before the shuffle.
    """
    kinds = ("input_tokens", "cache_creation_input_tokens", "cache_read_input_tokens",
             "output_tokens")
    used = sessions.where("has_usage")
    once = (used.where("message_id <> ''").groupBy("run_id", "message_id")
            .agg(F.min_by(F.struct(*kinds), F.struct("timestamp", "position")).alias("u"))
            .select("run_id", "u.*"))
    alone = used.where("message_id = ''").select("run_id", *kinds)
    sums = once.unionByName(alone).groupBy("run_id").agg(*[F.sum(k).alias(k) for k in kinds])
    return sums.withColumn("total", sum((F.col(k) for k in kinds[1:]), F.col(kinds[0])))


def returned_tokens(sessions: DataFrame) -> DataFrame:
    """A quarter of the characters tool results brought back; null where there was none."""
    blocks = F.filter(va.listed(F.col("content")), lambda b: F.coalesce(
        va.as_text(va.field(b, "type")) == "tool_result", F.lit(False)))
    chars = F.aggregate(blocks, F.lit(0).cast("bigint"), lambda n, b: n + F.coalesce(
        F.length(F.try_variant_get(b, "$.content", "string")), F.lit(4)))
    return (sessions.select("run_id", F.when(F.size(blocks) > 0, chars).alias("chars"))
            .groupBy("run_id").agg(F.floor(F.sum("chars") / fixed.CHARS_PER_TOKEN)
                                   .alias("context_from_files")))


def session_results(sessions: DataFrame) -> DataFrame:
    """Tool result texts of the session log."""
    blocks = F.filter(va.listed(F.col("content")), lambda b: F.coalesce(
        va.as_text(va.field(b, "type")) == "tool_result", F.lit(False)))
    return (sessions.select("run_id", F.explode(blocks).alias("b"))
            .select("run_id", va.prose_of(va.field(F.col("b"), "content")).alias("text"))
            .where("text <> ''"))


# --- whether a run counts -------------------------------------------------------

def run_counts(flags: DataFrame) -> DataFrame:
    """Whether a finished run counts, and the code of the first reason it does not.

    `flags` is (run_id, has_transcript, has_answer, has_files, looked_up).
    """
    why = F.lit("")
    for code, bad in (("looked_up", F.col("looked_up")), ("no_files", ~F.col("has_files")),
                      ("no_answer", ~F.col("has_answer")), ("no_transcript", ~F.col("has_transcript"))):
        why = F.when(bad, code).otherwise(why)
    return flags.select("run_id", (why == "").alias("counted"), why.alias("why"))


def models_seen(records: DataFrame) -> DataFrame:
    """The model each record names: `model_name` anywhere, `model` on the agent's own."""
    rec = F.col("rec")
    named = F.coalesce(va.first_text(rec, ("model_name",)),
                       F.when(is_agent(rec), va.first_text(rec, ("model",))))
    return records.select("run_id", named.alias("model")).where("model IS NOT NULL")


def model_agreement(asked: DataFrame, seen: DataFrame) -> DataFrame:
    """match, mismatch or unknown per run; names compared without their provider."""
    want = tx.model_name(F.col("requested"))
    joined = asked.join(seen.select("run_id", tx.model_name(F.col("model")).alias("_m")),
                        "run_id", "left")
    same = joined.groupBy("run_id").agg(
        F.first("requested", ignorenulls=True).alias("requested"), F.count("_m").alias("named"),
        F.bool_and(F.col("_m") == want).alias("_all"))
    return same.select("run_id", F.when(
        F.coalesce("requested", F.lit("")).eqNullSafe("") | (F.col("named") == 0), "unknown")
        .when(F.col("_all"), "match").otherwise("mismatch").alias("agreement"))


def fit_steps(steps: DataFrame, observation: str = "observation", other: str = "other_chars",
              budget: int = fixed.TRANSCRIPT_CHAR_BUDGET, cap: int = fixed.STEP_CAP,
              floor: int = fixed.STEP_FLOOR) -> DataFrame:
    """The largest cap on tool results that fits each run's steps in the budget.

    Caps halve down to the floor, then results go altogether. One aggregate holds
    a run's size under every cap, so no step is read twice. Returns steps with
    their result shortened to the cap chosen for the run.
    """
    caps = [cap]
    while caps[-1] > floor:
        caps.append(max(floor, caps[-1] // 2))
    caps.append(0)
    size = F.coalesce(F.length(observation), F.lit(0))

    def short(c: int) -> Column:
        note = 33 + F.length(F.format_number(size - c, 0))
        return F.when(size > c, c + note).otherwise(size)

    sums = steps.groupBy("run_id").agg(*[
        F.sum(F.col(other) + short(c)).alias(f"_at_{c}") for c in caps])
    chosen = F.lit(0)
    for c in reversed(caps[:-1]):
        chosen = F.when(F.col(f"_at_{c}") <= budget, c).otherwise(chosen)
    picked = sums.select("run_id", chosen.alias("cap"))
    cut = F.when(F.length(observation) > F.col("cap"), F.concat(
        F.substring(F.col(observation), F.lit(1), F.col("cap")), F.lit("\n... ["),
        F.format_number(F.length(observation) - F.col("cap"), 0),
        F.lit(" more characters of this result omitted]"))).otherwise(F.col(observation))
    return steps.join(picked, "run_id").withColumn(observation, cut)
