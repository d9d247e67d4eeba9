"""Tables that are read more than once, kept in the folder all machines share."""

from __future__ import annotations

import ctypes
import gc
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import DataFrame

from gaugeworks.session import shared_folder


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` written as Parquet in the shared folder and read back.

    What is read back is fixed: a lost executor re-reads files, it does not run
    the work behind them again, so samples, ids and partitions cannot change.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores before it until the frame has no such column."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


#: What a Python worker keeps from task to task, by name.
kept: dict[str, object] = {}


def begun() -> None:
    """At the start of work that uses nothing of `kept`: it goes."""
    if kept:
        given_back()


def given_back(keep: bool = False) -> None:
    """Gives memory a Python worker no longer uses back to the machine; workers outlive their tasks.

    What is in `kept` goes as well, unless `keep`: a worker that has come to other work does not hold it on.
    """
    if not keep:
        kept.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
