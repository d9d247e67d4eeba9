"""Row numbers and row frames over long series, without one task per series.

A plain `Window.partitionBy(series)` sends a series to one task. While the
longest series is under `max_rows` that is the cheapest plan and it is used.
Beyond it the rows are cut into ranges of (series, time, tie) first, so a task
holds about `max_rows` rows however they are spread over series and time stamps,
and frames are taken on position blocks with a halo copied from the neighbour.
Null time stamps come first on either path, as the ordering has it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from gaugeworks.session import cut_lineage

MAX_ROWS = 2_000_000
# Ranges the values of one quantile are cut into; so many counts come to the driver.
RANGES = 256
# Ranges rows are cut into before they hold more than `max_rows`: the driver keeps samples and sizes of each.
MAX_CHUNKS = 128


def longest_series(df: DataFrame, by: list[str]) -> int:
    """Rows of the longest series: one pre-aggregated pass, one number back."""
    row = df.groupBy(*by).count().agg(F.max("count")).first()
    return row[0] or 0


def _chunks(rows: int, max_rows: int) -> int:
    """Ranges of about `max_rows` rows; of more, up to MAX_ROWS, where there would be over MAX_CHUNKS."""
    return max(2, min(-(-rows // max_rows), max(MAX_CHUNKS, -(-rows // MAX_ROWS))))


def _chunked(df: DataFrame, order: list[str], max_rows: int) -> DataFrame:
    """Rows in ranges of the order, numbered upwards; written, since ranges are sampled."""
    chunks = _chunks(df.count(), max_rows)
    return cut_lineage(df.repartitionByRange(chunks, *order).withColumn("_chunk", F.spark_partition_id()))


def running_sum(df: DataFrame, by: list[str], ts: str, tie: str, value: Column, name: str,
                max_rows: int = MAX_ROWS, longest: int | None = None) -> DataFrame:
    """Add the running total of `value` up to and with each row of its series.

    `longest` is the row count of the longest series where the caller has it.
    """
    upto = Window.unboundedPreceding, Window.currentRow
    if (longest_series(df, by) if longest is None else longest) <= max_rows:
        order = Window.partitionBy(*by).orderBy(ts, tie).rowsBetween(*upto)
        return df.withColumn(name, F.sum(value).over(order).cast("bigint"))
    chunked = _chunked(df, [*by, ts, tie], max_rows)
    before = Window.partitionBy(*by).orderBy("_chunk").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = (chunked.groupBy(*by, "_chunk").agg(F.sum(value).alias("_n"))
               .select(*by, "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0))
                       .alias("_offset")))
    order = Window.partitionBy(*by, "_chunk").orderBy(ts, tie).rowsBetween(*upto)
    return (chunked.withColumn("_local", F.sum(value).over(order))
            .join(offsets, [*by, "_chunk"])
            .withColumn(name, (F.col("_offset") + F.col("_local")).cast("bigint"))
            .drop("_chunk", "_offset", "_local"))


def number_rows(df: DataFrame, by: list[str], ts: str, tie: str,
                max_rows: int = MAX_ROWS, longest: int | None = None) -> DataFrame:
    """Add `pos`, the 0-based row position of a row in its series."""
    out = running_sum(df, by, ts, tie, F.lit(1), "pos", max_rows, longest)
    return out.withColumn("pos", F.col("pos") - 1)


def over_positions(df: DataFrame, by: list[str], exprs: dict[str, Callable],
                   before: int = 0, after: int = 0, block: int = 65_536,
                   max_rows: int = MAX_ROWS, longest: int | None = None) -> DataFrame:
    """Window expressions over dense positions, at most `block` + halo rows a group.

    Each of `exprs` takes an ordered window and gives a column reading no further
    than `before` rows back and `after` rows on.
    """
    if (longest_series(df, by) if longest is None else longest) <= max_rows:
        whole = Window.partitionBy(*by).orderBy("pos")
        return df.select("*", *[make(whole).alias(n) for n, make in exprs.items()])
    if block < max(before, after):
        raise ValueError("a block has to be at least as long as its halo")
    home = F.floor(F.col("pos") / block)
    at = F.col("pos") % block
    copies = F.array_compact(F.array(
        home,
        F.when(at >= block - before, home + 1),
        F.when((at < after) & (home > 0), home - 1)))
    halo = df.withColumn("_block", F.explode(copies))
    window = Window.partitionBy(*by, "_block").orderBy("pos")
    return (halo.select("*", *[make(window).alias(n) for n, make in exprs.items()])
            .filter(F.col("_block") == home).drop("_block"))


def exact_quantiles(df: DataFrame, column: str, probs: list[float],
                    limit: int = 1_000_000) -> list[float]:
    """Exact linearly interpolated quantiles of one column.

    Small inputs go to the built-in exact percentile. Beyond `limit` rows that
    aggregate would hold every distinct value in one task, so an approximate
    bracket is taken, the rows under it are counted, and only the bracket is
    sorted; a bracket that is still large is bracketed again.
    """
    values = df.select(F.col(column).cast("double").alias("v")).where("v IS NOT NULL")
    n = values.count()
    if n == 0:
        return [None] * len(probs)
    if n <= limit:
        row = values.agg(F.percentile("v", F.array(*[F.lit(p) for p in probs]))).first()
        return list(row[0])
    out = []
    for p in probs:
        rank = (n - 1) * p
        low, part = int(rank), rank - int(rank)
        first = _order_statistic(values, low, n, limit)
        second = _order_statistic(values, min(low + 1, n - 1), n, limit) if part else first
        out.append(first + (second - first) * part)
    return out


def _order_statistic(values: DataFrame, rank: int, n: int, limit: int) -> float:
    below, rows = 0, n
    while rows > limit:
        share, err = (rank - below) / rows, 0.005
        low, high = values.approxQuantile(
            "v", [max(0.0, share - 2 * err), min(1.0, share + 2 * err)], err)
        if low == high:
            counts = values.agg(F.count_if(F.col("v") < low), F.count_if(F.col("v") <= low)).first()
            if below + counts[0] <= rank < below + counts[1]:
                return low
        inside = values.where(F.col("v").between(low, high))
        under = values.where(F.col("v") < low).count()
        count = inside.count()
        if not (below + under <= rank < below + under + count) or count == rows:
            break
        values, below, rows = inside, below + under, count
    # The bracket does not close: ranges of the values, and only the one that holds the rank is sorted.
    placed = cut_lineage(values.groupBy("v").count().repartitionByRange(RANGES, "v")
                         .withColumn("_chunk", F.spark_partition_id()))
    ahead = 0
    for chunk, held in sorted(placed.groupBy("_chunk").agg(F.sum("count")).collect()):
        if ahead + held > rank - below:
            break
        ahead += held
    running = Window.orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    inside = placed.where(F.col("_chunk") == chunk).select("v", (F.sum("count").over(running) + ahead).alias("upto"))
    return inside.where(F.col("upto") > rank - below).agg(F.min("v")).first()[0]
