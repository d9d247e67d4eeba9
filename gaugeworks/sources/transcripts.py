"""Run transcripts and session logs, several dialects, as one table of records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gaugeworks import fixed
from gaugeworks.functions import text as tx, variants as va

SESSION_SCHEMA = (
    "timestamp STRING, usage STRUCT<input_tokens: BIGINT, cache_creation_input_tokens: BIGINT, "
    "cache_read_input_tokens: BIGINT, output_tokens: BIGINT>, "
    "message STRUCT<id: STRING, usage: STRUCT<input_tokens: BIGINT, "
    "cache_creation_input_tokens: BIGINT, cache_read_input_tokens: BIGINT, "
    "output_tokens: BIGINT>, content: VARIANT>")


def records_of(documents: DataFrame, document: str = "document") -> DataFrame:
    """One row per record of a transcript document: a bare list, or under one of six keys."""
    parsed = F.try_parse_json(F.col(document))
    bare = F.try_variant_get(parsed, "$", "array<variant>")
    named = [F.try_variant_get(parsed, f"$.{k}", "array<variant>") for k in fixed.RECORD_LISTS]
    return documents.select(
        *[c for c in documents.columns if c != document],
        F.posexplode(F.coalesce(bare, *named)).alias("turn", "rec"))


def parse_records(rows: DataFrame, record: str = "record") -> DataFrame:
    """Rows carrying one record's JSON each, parsed once; unreadable ones left out."""
    return (rows.withColumn("rec", F.try_parse_json(F.col(record))).drop(record)
            .where(va.is_object(F.col("rec"))))


def is_agent(rec: Column) -> Column:
    said = F.transform(va.fields(rec, fixed.SPEAKER_KEYS), lambda v: F.lower(tx.strip(
        va.as_text(v))))
    return F.exists(F.array_compact(said), lambda s: s.isin(*fixed.AGENT_MARKERS))


def _sidechain(rec: Column) -> Column:
    keys = [f"{at}{k}" for at in ("", "extra.") for k in ("is_sidechain", "isSidechain")]
    return F.exists(va.fields(rec, keys), lambda v: F.coalesce(
        F.try_variant_get(v, "$", "boolean"), F.lit(False)))


def _stop_reason(rec: Column) -> Column:
    keys = [f"{at}{k}" for at in ("", "extra.") for k in ("stop_reason", "finish_reason")]
    return F.get(F.array_compact(F.transform(va.fields(rec, keys), va.as_text)), 0)


CALL_KEYS = ("tool_calls", "tool_call", "function_call", "actions", "tools")


def _call_blocks(rec: Column) -> Column:
    return F.filter(va.listed(va.field(rec, "content")), lambda b: F.coalesce(
        va.as_text(va.field(b, "type")).isin("tool_use", "tool_call"), F.lit(False)))


def _own_calls(rec: Column) -> Column:
    return F.filter(F.flatten(F.transform(va.fields(rec, CALL_KEYS), va.items)), va.is_object)


def steps(records: DataFrame) -> DataFrame:
    """The canonical step of each record; records holding nothing are left out.

    Columns: speaker, text, role (model, task, result, helper or other), is_agent,
    is_own (the agent itself, not one it started) and stop_reason.
    """
    rec = F.col("rec")
    keep = [c for c in records.columns if c != "rec"]
    said = F.filter(F.transform(va.fields(rec, fixed.TEXT_KEYS), lambda v: tx.strip(
        va.prose_of(v))), lambda s: s != "")
    flat = F.size(F.array_compact(va.fields(rec, ("tool_name", "command"))))
    raw = records.select(
        *keep, va.first_text(rec, fixed.SPEAKER_KEYS).alias("speaker"),
        F.coalesce(F.get(said, 0), F.lit("")).alias("text"), is_agent(rec).alias("is_agent"),
        _sidechain(rec).alias("_side"), _stop_reason(rec).alias("stop_reason"),
        (F.size(_own_calls(rec)) + F.size(_call_blocks(rec)) + flat).alias("n_calls"))
    helper = F.col("_side") | (~F.col("is_agent") & F.col("text").startswith(
        fixed.NOTIFICATION_PREFIX))
    low = F.lower("speaker")
    role = (F.when(helper, "helper").when(F.col("is_agent"), "model")
            .when(low.isin(*fixed.TASK_SPEAKERS), "task")
            .when(low.isin(*fixed.RESULT_SPEAKERS), "result").otherwise("other"))
    return raw.where("speaker IS NOT NULL OR text <> '' OR n_calls > 0").select(
        *keep, F.coalesce("speaker", F.lit("?")).alias("speaker"),
        tx.drop_encoded(F.col("text")).alias("text"), role.alias("role"), "is_agent",
        (F.col("is_agent") & ~F.col("_side")).alias("is_own"), "stop_reason")


def tool_calls(records: DataFrame) -> DataFrame:
    """Calls of every record: (tool, argument, description, call_id), a row each.

    A call is an item under one of five keys, a content block, or the record
    itself where it carries a tool name or a command. The description is taken
    out of the argument it came in.
    """
    keep = [c for c in records.columns if c != "rec"]
    rec = F.col("rec")
    itself = F.when(F.size(F.array_compact(va.fields(rec, ("tool_name", "command")))) > 0,
                    F.array(rec)).otherwise(F.array().cast(va.NO_VARIANTS))
    tag = lambda kind: (lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("v")))
    every = F.concat(F.transform(_own_calls(rec), tag("item")),
                     F.transform(_call_blocks(rec), tag("block")), F.transform(itself, tag("flat")))
    rows = records.select(*keep, F.explode(every).alias("c")).select(*keep, "c.kind", "c.v")
    inner = va.field(F.col("v"), "function")
    rows = rows.withColumn("fn", F.when((F.col("kind") == "item") & va.is_object(inner), inner)
                           .otherwise(F.col("v")))
    kind, v, fn = F.col("kind"), F.col("v"), F.col("fn")
    named = rows.select(
        *keep,
        F.when(kind == "item", F.coalesce(va.first_shown(fn, ("name",)), va.first_shown(
            v, ("function_name", "tool", "type"))))
        .when(kind == "block", va.first_shown(v, ("name",)))
        .otherwise(F.coalesce(va.first_shown(v, ("tool_name",)), F.lit("command"))).alias("tool"),
        F.when(kind == "item", F.coalesce(va.first_value(fn, ("arguments", "input")),
                                          va.first_value(v, ("args",))))
        .when(kind == "block", va.first_value(v, ("input",)))
        .otherwise(va.first_value(v, ("command", "input", "args"))).alias("raw"),
        F.when(kind == "flat", "").otherwise(F.coalesce(va.first_shown(
            v, ("tool_call_id", "id")), F.lit(""))).alias("call_id"),
        F.when(kind == "flat", va.first_text(v, ("description",))).alias("note"))
    raw = F.col("raw")
    opened = named.withColumn("opened", F.when(va.is_text(raw), F.coalesce(
        F.try_parse_json(va.as_text(raw)), raw)).otherwise(raw))
    said = opened.withColumn("said", va.first_text(F.col("opened"), fixed.DESCRIPTION_KEYS))
    parts = F.map_filter(F.try_variant_get("opened", "$", "map<string,variant>"), lambda k, x: ~(
        k.isin(*fixed.DESCRIPTION_KEYS) & va.is_text(x)))
    argument = F.when(F.col("said").isNotNull() | ~va.is_text(raw), F.coalesce(
        F.to_json(parts), va.shown(raw))).otherwise(va.shown(raw))
    return said.where("tool IS NOT NULL").select(
        *keep, "tool", F.coalesce(argument, F.lit("")).alias("argument"),
        F.coalesce("said", "note", F.lit("")).alias("description"), "call_id")


def tool_results(records: DataFrame) -> DataFrame:
    """Results of every record: (call_id, text), blocks and observations, a row each."""
    keep = [c for c in records.columns if c != "rec"]
    rec = F.col("rec")
    holder = F.coalesce(va.field(rec, "message.content"), va.field(rec, "content"))
    blocks = F.filter(va.listed(holder), lambda b: F.coalesce(
        va.as_text(va.field(b, "type")).isin("tool_result", "function_result"), F.lit(False)))
    every = F.concat(blocks, va.listed(va.field(rec, "observation.results")))
    rows = records.select(*keep, F.explode(every).alias("v"))
    v = F.col("v")
    body = F.when(va.is_object(v), va.field(v, "content")).otherwise(v)
    ident = va.first_shown(v, ("tool_use_id", "source_call_id", "tool_call_id", "id"))
    return (rows.withColumn("body", body).select(
        *keep, F.coalesce(ident, F.lit("")).alias("call_id"),
        va.prose_of(F.col("body")).alias("text")).where(F.col("text").rlike(r"(?U)\S")))


def session_rows(lines: DataFrame, line: str = "line") -> DataFrame:
    """Session log lines held as text, parsed; unreadable lines skipped."""
    parsed = lines.withColumn("_r", F.from_json(line, SESSION_SCHEMA)).drop(line)
    fields = ("input_tokens", "cache_creation_input_tokens", "cache_read_input_tokens",
              "output_tokens")
    usage = F.coalesce("_r.message.usage", "_r.usage")
    return (parsed.where("_r.timestamp IS NOT NULL OR _r.message IS NOT NULL OR _r.usage IS NOT NULL")
            .select(*[c for c in parsed.columns if c != "_r"],
                    F.coalesce("_r.timestamp", F.lit("")).alias("timestamp"),
                    F.coalesce("_r.message.id", F.lit("")).alias("message_id"),
                    usage.isNotNull().alias("has_usage"),
                    *[F.coalesce(usage[f], F.lit(0)).alias(f) for f in fields],
                    F.col("_r.message.content").alias("content")))
