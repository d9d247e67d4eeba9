"""Registered queries: each reads the given tables and names its SQL counterpart.

`VIEWS` are derivations written once in SQL both engines run. A view built by an
operator has a builder for Spark and a SQL text for the comparison engine. In
all of these `{name}` stands for a table or a view, and `{{` for a brace.
"""

from __future__ import annotations

from collections.abc import Callable
from string import Formatter

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# Text tables and their keys, and the stored bytes of text one task may have.
TEXT_TABLES = {"documents": "doc_id", "conversations": "conv_id", "pages": "page_id"}
ONE_SPLIT = 16 * 1024 * 1024

VIEWS: dict[str, str] = {}
BUILT: dict[str, tuple[Callable[["Inputs"], DataFrame], str]] = {}
QUERIES: dict[str, Callable[["Inputs"], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def names_in(sql: str) -> list[str]:
    return list(dict.fromkeys(n for _, n, _, _ in Formatter().parse(sql) if n))


class Inputs:
    """The tables of one folder, and the views over them, each built once."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._held: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._held:
            if name in TABLES:
                made = self._read(name)
            elif name in BUILT:
                made = BUILT[name][0](self)
            else:
                made = self.sql(VIEWS[name])
            self._held[name] = made
        return self._held[name]

    def _read(self, name: str) -> DataFrame:
        """A table; a text table is spread over the cores first, a large one in parts of bounded size.

        A file may be one row group however large it is, and a row group is one task.
        """
        path = f"{self.folder}/{name}.parquet"
        df = self.spark.read.parquet(path)
        if name in TEXT_TABLES:
            jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
            held = jvm.org.apache.hadoop.fs.Path(path)
            size = held.getFileSystem(conf).getContentSummary(held).getLength()
            parts = max(self.spark.sparkContext.defaultParallelism, -(-size // ONE_SPLIT))
            return df.repartition(parts, TEXT_TABLES[name])
        return df

    def sql(self, text: str) -> DataFrame:
        needed = {n: getattr(self, n) for n in names_in(text)}
        return self.spark.sql(text, **needed)


def view(name: str, sql: str) -> None:
    VIEWS[name] = sql


def built(name: str, sql: str):
    def keep(make):
        BUILT[name] = (make, sql)
        return make
    return keep


def query(name: str, oracle: str | None = None):
    def keep(make):
        if name in QUERIES:
            raise ValueError(f"two queries are called {name}")
        QUERIES[name] = make
        if oracle is not None:
            ORACLES[name] = oracle
        return make
    return keep


def render(sql: str) -> str:
    """The comparison SQL with every view it needs as a WITH clause."""
    order: list[str] = []

    def need(text: str) -> None:
        for n in names_in(text):
            if n in TABLES or n in order:
                continue
            inner = BUILT[n][1] if n in BUILT else VIEWS[n]
            need(inner)
            if n not in order:
                order.append(n)

    need(sql)

    def plain(text: str) -> str:
        return text.format(**{n: n for n in names_in(text)})

    body = plain(sql).strip()
    ctes = [f"{n} AS ({plain(BUILT[n][1] if n in BUILT else VIEWS[n])})" for n in order]
    if not ctes:
        return body
    # A text with a WITH clause of its own goes on from the views'.
    head = "WITH RECURSIVE " if body.startswith("WITH RECURSIVE ") else "WITH "
    joined = ",\n" + body[len(head):] if body.startswith("WITH ") else "\n" + body
    return head + ",\n".join(ctes) + joined
