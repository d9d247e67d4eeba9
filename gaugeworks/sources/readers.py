"""Scans and sinks of files, with declared schemas."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gaugeworks import fixed
from gaugeworks.functions import text as tx
from gaugeworks.sources.transcripts import SESSION_SCHEMA

OBSERVATIONS = (
    "timestamp TIMESTAMP_NTZ, zone STRING, product_type STRING, telemetry_status STRING, "
    "demand_mw DOUBLE, renewable_generation_mw DOUBLE, temperature_c DOUBLE, "
    "fuel_index_usd_mmbtu DOUBLE, hour INT, day_of_week INT, weekend_flag INT, price_usd_mwh DOUBLE")
PREDICTIONS = (
    "timestamp TIMESTAMP_NTZ, zone STRING, product_type STRING, telemetry_status STRING, "
    "is_eligible_eval BOOLEAN, split_phase STRING, actual_price DOUBLE, predicted_price DOUBLE")
GRADED_ROW = ("id STRING, title STRING, weight INT, type ARRAY<STRING>, score STRUCT<rubric_statement: STRING, "
              "status: STRING, score: STRING, justification: STRING>, unmeasured STRING, unmeasured_reason STRING")


def read_csv(spark: SparkSession, path: str, schema: str = OBSERVATIONS) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True)


def write_table(df: DataFrame, path: str, kind: str = "parquet") -> None:
    df.write.mode("overwrite").options(**({"header": True} if kind == "csv" else {})).format(kind).save(path)


def csv_rows(line: Column, schema: str) -> Column:
    """A CSV line held as text, as a struct."""
    return F.from_csv(line, schema)


def graded_rows(documents: DataFrame, column: str = "document") -> DataFrame:
    """Rows of graded results, written as a bare list or under `rubric_scores`."""
    bare = F.from_json(column, f"array<struct<{_struct(GRADED_ROW)}>>")
    nested = F.from_json(F.get_json_object(column, "$.rubric_scores"), f"array<struct<{_struct(GRADED_ROW)}>>")
    rows = F.when(F.trim(column).startswith("["), bare).otherwise(nested)
    keep = [c for c in documents.columns if c != column]
    return documents.select(*keep, F.inline(rows))


def _struct(ddl: str) -> str:
    from pyspark.sql.types import StructType
    return StructType.fromDDL(ddl).simpleString()[len("struct<"):-1]


def read_sessions(spark: SparkSession, path: str) -> DataFrame:
    """Session logs: one JSON object a line, unreadable lines skipped; order by timestamp to read."""
    return (spark.read.schema(SESSION_SCHEMA).option("mode", "DROPMALFORMED")
            .option("recursiveFileLookup", "true").option("pathGlobFilter", "*.jsonl").json(path)
            .withColumn("path", F.col("_metadata.file_path")))


def read_transcripts(spark: SparkSession, path: str) -> DataFrame:
    """Whole transcript files with the time they were last written."""
    return (spark.read.option("wholetext", "true").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*trajectory*.json").text(path)
            .select(F.col("_metadata.file_path").alias("path"),
                    F.col("_metadata.file_modification_time").alias("modified"),
                    F.col("value").alias("document")))


def read_workspace(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(corpus, unreadable): readable texts of a folder, and the files that are not."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
             .where(tx.base_name(F.col("path")) != fixed.PLACEHOLDER_FILE))
    readable = tx.suffix(F.col("path")).isin(*fixed.TEXT_SUFFIXES)
    return (files.where(readable).select("path", F.decode("content", "UTF-8").alias("text")),
            files.where(~readable).select("path", "length"))


def list_files(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
            .select("path", "length", F.col("modificationTime").alias("modified"))
            .where(tx.base_name(F.col("path")) != fixed.PLACEHOLDER_FILE))


def read_yaml(path: str) -> dict:
    """A small parameter file; `key: value` pairs nested by indentation, and `- item` lists."""
    try:
        import yaml
    except ImportError:
        return _plain_yaml(Path(path).read_text())
    return yaml.safe_load(Path(path).read_text())


def _plain_yaml(text: str) -> dict:
    import json

    root: dict = {}
    stack: list[tuple[int, object]] = [(-1, root)]
    for raw in text.splitlines():
        line = raw.split(" #")[0].rstrip()
        if not line.strip() or line.lstrip().startswith("#"):
            continue
        depth, body = len(line) - len(line.lstrip()), line.strip()
        while stack[-1][0] >= depth:
            stack.pop()
        held = stack[-1][1]
        value = body[2:] if body.startswith("- ") else body.partition(":")[2].strip()
        try:
            value = json.loads(value)
        except ValueError:
            pass
        if body.startswith("- "):
            held.setdefault("_items", []).append(value)
        elif value == "":
            held[body[:-1]] = {}
            stack.append((depth, held[body[:-1]]))
        else:
            held[body.partition(":")[0]] = value
    return _lists(root)


def _lists(node):
    if isinstance(node, dict):
        if set(node) == {"_items"}:
            return node["_items"]
        return {k: _lists(v) for k, v in node.items()}
    return node
