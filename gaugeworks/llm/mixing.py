"""Mixing sources to target weights at exact word budgets.

Each document has a hash-random place within its source. Ranges of the hash are
pre-aggregated, a prefix sum over ranges finds the one in which a source's budget
ends, and only that range is sorted. What is left is one cut per source, which a
join on the source applies to the documents: no text is shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.llm.store import fresh, written
from gaugeworks.llm.words import WORD

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
SEED = "mix-1"
#: Documents one range of hashes is meant to hold.
RANGE_ROWS = 50_000
KEY_BITS = 60


def _wide(x: Column | str) -> Column:
    return (F.col(x) if isinstance(x, str) else x).cast("decimal(38,0)")


def placed(df: DataFrame, seed: str = SEED) -> DataFrame:
    """Size, source key and hash-random place of each document of `df`.

    A null text has size 0; a null source is a source of its own. Documents that
    agree in id, source, size and text share one place.
    """
    return df.select(*_place_columns(seed))


def numbered(df: DataFrame, *order: Column) -> DataFrame:
    """`df` with `number` from 0 in the order: rows in range partitions, plus the counts before each."""
    kept = written(df.orderBy(*order).select(
        "*", F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("within")), "numbered")
    # One row for each partition, however many rows there are.
    ahead = kept.groupBy("part").count().withColumn(
        "ahead", F.coalesce(F.sum("count").over(
            Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return (kept.join(ahead.select("part", "ahead"), "part")
            .withColumn("number", F.col("ahead") + F.col("within")).drop("part", "within", "ahead"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """The words each source is to give: (s, source_size, target, budget).

    `sizes` has (s, source_size). Weights repeat over the sources in code point
    order, the null source last. A source gives at most three times its size; what
    it cannot give is shared again by weight until none is above. Sums are exact
    integers; a target is one division.
    """
    ranked = numbered(sizes, F.col("s") == "n", F.col("s"))
    share = reduce(lambda made, k: made.when(F.col("number") % len(weights) == k, F.lit(weights[k])),
                   range(1, len(weights)), F.when(F.col("number") % len(weights) == 0, F.lit(weights[0])))
    ranked = written(ranked.withColumn("w", share.cast("long")).withColumn("most", F.col("source_size") * MOST_EPOCHS),
                     "sources")

    def full(left: int, over: int) -> Column:
        return _wide("most") * F.lit(over).cast("decimal(18,0)") <= _wide("w") * F.lit(left).cast("decimal(20,0)")

    start = ranked.agg(F.sum("source_size").alias("n"), F.sum("w").alias("w")).first()
    total, left, over = start.n or 0, start.n or 0, start.w or 1
    while True:  # the set of full sources only grows
        row = ranked.agg(F.sum(F.when(full(left, over), F.col("most"))).alias("given"),
                         F.sum(F.when(~full(left, over), F.col("w"))).alias("w")).first()
        now = (total - (row.given or 0), row.w or 0)
        if not now[1] or now == (left, over):
            break
        left, over = now
    even = (F.col("w") * F.lit(left)).cast("double") / F.lit(float(over))
    target = F.when(full(left, over), F.col("most").cast("double")).otherwise(even)
    return ranked.select("s", "source_size", target.alias("target"),
                         F.floor(target + 0.5).cast("long").alias("budget"))


def cuts(places: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """One row for each source: target, whole epochs, and the place its last epoch ends at.

    `cut` is null where an epoch ends with the source. Of the document at the cut
    (or of each of several that share its place) `part` words are taken.
    """
    per = places.groupBy("s").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    per = written(per, "sizes")
    largest = per.agg(F.max("n")).first()[0] or 0
    bits = max(0, (largest // RANGE_ROWS).bit_length())
    goal = targets(per.select("s", "source_size"), weights)
    epochs = F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(F.lit(0).cast("long"))
    goal = written(goal.withColumn("epochs", epochs)
                   .withColumn("rest", F.col("budget") - F.col("epochs") * F.col("source_size")), "targets")

    ranged = places.withColumn("range", F.shiftright("key", KEY_BITS - bits))
    running = Window.partitionBy("s").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (ranged.groupBy("s", "range").agg(F.sum("size").alias("words"))
              .withColumn("ahead", F.coalesce(F.sum("words").over(running), F.lit(0))))
    ends = (ranges.join(goal.filter("rest > 0").select("s", "rest"), "s")
            .filter("ahead < rest AND rest <= ahead + words").select("s", "range", "ahead", "rest"))
    inside = (ranged.join(written(ends, "ends"), ["s", "range"])
              .groupBy("s", "key", "id", "size", "same", "ahead", "rest").agg(F.count("*").alias("n")))
    placed_at = F.struct("key", "id", "size", "same")
    so_far = F.coalesce(F.sum(F.col("size") * F.col("n")).over(
        Window.partitionBy("s").orderBy("key", "id", "size", "same")
        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.col("ahead")
    at = (inside.withColumn("before", so_far)
          .filter("before < rest AND rest <= before + size * n")
          .select("s", placed_at.alias("cut"), F.expr("(rest - before) div n").alias("part")))
    return goal.select("s", "source_size", "target", "epochs", "rest").join(at, "s", "left")


def mix(df: DataFrame, weights: tuple[int, ...] = WEIGHTS, seed: str = SEED) -> DataFrame:
    """`df` (doc_id, text, source and others) with size, source_size, target and taken.

    `taken` counts the words of the document the mix takes, repeats counted: the
    size times the source's whole epochs, once more before the cut, and a part of
    the document the cut falls in. Each source's sum is its target rounded; where
    rows agreeing in every column stand at the cut they share it evenly.

    Null text: size and taken 0. Null source: one source, last. Null or repeated
    ids: allowed, the text tells the rows apart. Empty table: empty result.
    A column already called like a result is kept under its name, and the result
    gets an underscore before it.
    """
    put = fresh(df, "size", "source_size", "target", "taken")
    held = fresh(df, "mix_place", "s", "mix_goal")
    place = written(placed(df, seed), "places")
    cut = written(cuts(place, weights), "cuts")
    marked = df.withColumn(held[0], F.struct(*_place_columns(seed))).withColumn(held[1], F.col(f"{held[0]}.s"))
    cut = cut.select(F.col("s").alias(held[1]), F.struct("source_size", "target", "epochs", "rest", "cut", "part").alias(held[2]))
    both = marked.join(cut, held[1], "left")
    p, g = held[0], held[2]
    mine = F.struct(*(F.col(f"{p}.{c}").alias(c) for c in ("key", "id", "size", "same")))
    extra = (F.when(F.col(f"{g}.cut").isNull(), F.lit(0).cast("long"))
             .when(mine < F.col(f"{g}.cut"), F.col(f"{p}.size"))
             .when(mine == F.col(f"{g}.cut"), F.col(f"{g}.part")).otherwise(F.lit(0).cast("long")))
    return both.select(*(F.col(f"`{c}`") for c in df.columns),
                       F.col(f"{p}.size").alias(put[0]), F.col(f"{g}.source_size").alias(put[1]),
                       F.col(f"{g}.target").alias(put[2]),
                       (F.col(f"{g}.epochs") * F.col(f"{p}.size") + extra).alias(put[3]))


def _place_columns(seed: str) -> list[Column]:
    text = F.coalesce("text", F.lit(""))
    same = F.md5(text)
    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    key = F.md5(F.concat_ws("/", F.lit(seed), doc, same))
    return [F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), "source")).alias("s"),
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
            F.conv(F.substring(key, 1, KEY_BITS // 4), 16, 10).cast("long").alias("key"),
            doc.alias("id"), same.alias("same")]


def repeated(df: DataFrame, weights: tuple[int, ...] = WEIGHTS, seed: str = SEED) -> DataFrame:
    """The mixed documents themselves, in the columns of `df`: a row for each copy taken.

    The copy the budget ends in holds the text up to the last word taken.
    """
    kept = [F.col(f"`{c}`") for c in df.columns]
    mixed = mix(df, weights, seed)
    size, taken = (F.col(f"`{c}`") for c in (mixed.columns[-4], mixed.columns[-1]))
    whole, part = F.expr(f"`{mixed.columns[-1]}` div `{mixed.columns[-4]}`"), taken % size
    copies = F.when(size > 0, F.concat(
        F.array_repeat(F.lit(0).cast("long"), whole.cast("int")),
        F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<long>"))))
    one, = fresh(mixed, "copy_of_mix")
    rows = mixed.withColumn(one, F.explode(copies))
    # Each piece is a word with the blanks before it.
    start = F.array_join(F.slice(F.split("text", r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])"),
                                 F.lit(1), F.col(one).cast("int")), "")
    text = F.when(F.col(one) > 0, start).otherwise(F.col("text"))
    out = rows.select(*[text.alias("text") if c == "text" else k for c, k in zip(df.columns, kept)])
    if "n_chars" in df.columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out


ORACLE = rf"""
WITH RECURSIVE p AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS s,
         CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size,
         substr(md5('{SEED}/' || coalesce(CAST(doc_id AS VARCHAR), '') || '/' || md5(coalesce(text, ''))), 1, 15) AS key,
         coalesce(CAST(doc_id AS VARCHAR), '') AS id, md5(coalesce(text, '')) AS same
  FROM documents),
z AS (SELECT s, CAST(sum(size) AS HUGEINT) AS source_size FROM p GROUP BY s),
w AS (SELECT s, source_size, 3 * source_size AS most,
             CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY s = 'n', s) - 1) % 3] AS HUGEINT) AS w FROM z),
rounds AS (
  SELECT 0 AS i, sum(source_size)::HUGEINT AS total, sum(source_size)::HUGEINT AS left_, sum(w)::HUGEINT AS over_ FROM w
  UNION ALL
  SELECT i + 1, total,
         total - sum(CASE WHEN most * over_ <= w * left_ THEN most ELSE 0 END)::HUGEINT,
         sum(CASE WHEN most * over_ <= w * left_ THEN 0 ELSE w END)::HUGEINT
  FROM rounds, w WHERE i < 60 AND over_ > 0 GROUP BY i, total),
final AS (SELECT left_, over_ FROM rounds WHERE over_ > 0 ORDER BY i DESC LIMIT 1),
t AS (SELECT s, source_size, CASE WHEN most * over_ <= w * left_ THEN CAST(most AS DOUBLE)
             ELSE CAST(w * left_ AS DOUBLE) / CAST(over_ AS DOUBLE) END AS target FROM w, final),
g AS (SELECT s, source_size, target, CAST(floor(target + 0.5) AS HUGEINT) AS budget FROM t),
e AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM g),
u AS (SELECT s, key, id, size, same, count(*) AS n FROM p GROUP BY ALL),
r AS (SELECT u.*, coalesce(sum(size * n) OVER (PARTITION BY s ORDER BY key, id, size, same
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM u)
SELECT p.doc_id, p.size, CAST(e.source_size AS BIGINT) AS source_size, e.target,
       CAST(e.epochs * p.size + CASE
         WHEN r.before + r.size * r.n <= e.budget - e.epochs * e.source_size THEN p.size
         WHEN r.before < e.budget - e.epochs * e.source_size
         THEN (e.budget - e.epochs * e.source_size - r.before) // r.n ELSE 0 END AS BIGINT) AS taken
FROM p JOIN e USING (s) JOIN r USING (s, key, id, size, same)
"""
