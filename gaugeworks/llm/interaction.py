"""How document filters interact: what each removes in every order they can be applied in.

A document's failures are one mask. Masks are counted, and all orders are read from
the counts: what is left after some filters is the number of masks free of their bits.

Repeats are found behind a counting Bloom sketch. Each task counts the cells its texts
fall in, the counts add up over the tasks, and a text with a cell of its own is unique
for certain. Only the others are shuffled, whole, for the smallest id of each text.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.store import written
from gaugeworks.llm.words import WORD

FILTERS = "ABCDE"
ORDERS = tuple("".join(p) for p in permutations(FILTERS))
#: Cells of a sketch block, a power of two, and cells the sketch has for each text.
BLOCK_CELLS, CELLS_A_TEXT = 4096, 16
#: Bits of the text's hash that name its block at most; three cells take twelve bits each of the rest.
BLOCK_BITS = 28
#: Crowded cells (two bytes each) that are broadcast at most; with more the sketch is joined by a shuffle.
MOST_BROADCAST = 1 << 24


def _whole() -> Column:
    return F.coalesce("text", F.lit(""))


def _probes(blocks: int) -> list[Column]:
    """The block of a text, and its three cells in it."""
    h = F.xxhash64("text")
    cells = [F.shiftrightunsigned(h, BLOCK_BITS + 12 * k).bitwiseAND(F.lit(BLOCK_CELLS - 1)).cast("short") for k in range(3)]
    return [h.bitwiseAND(F.lit(blocks - 1)).alias("block"), F.array(*cells).alias("cells")]


def crowded(texts: DataFrame, blocks: int) -> DataFrame:
    """(block, crowd): the cells of each block in which two or more texts of (text) fall."""
    cells = texts.select(*_probes(blocks)).select("block", F.explode(F.array_distinct("cells")).alias("cell"))
    counted = cells.groupBy("block", "cell").agg(F.count("*").alias("n"))
    # At most BLOCK_CELLS of them.
    return counted.filter("n > 1").groupBy("block").agg(F.collect_list("cell").alias("crowd"))


def screened(texts: DataFrame) -> DataFrame:
    """`texts` (text and others, no text null) with `maybe`: false where no other row has the same text.

    The sketch grows with the rows. Up to MOST_BROADCAST crowded cells it goes to every
    task, and texts stay where they are; beyond that rows move to their block.
    """
    blocks = 1 << min(BLOCK_BITS, max(0, (texts.count() * CELLS_A_TEXT // BLOCK_CELLS).bit_length()))
    sketch = written(crowded(texts, blocks), "sketch")
    size = sketch.agg(F.sum(F.size("crowd")).alias("n")).first().n or 0
    sketch = F.broadcast(sketch) if size <= MOST_BROADCAST else sketch.hint("shuffle_hash")
    probed = texts.select("*", *_probes(blocks)).join(sketch, "block", "left")
    inside = F.forall("cells", lambda c: F.array_contains("crowd", c))
    return probed.withColumn("maybe", F.coalesce(inside, F.lit(False))).drop("block", "cells", "crowd")


def failures(text: Column) -> Column:
    """Bits 0 to 3 for A to D: too short, too repetitive, too many capitals, a special sign."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    sizes = F.transform(F.array(words), lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("d")))[0]
    capitals = F.regexp_count(text, F.lit("[A-Z]"))
    masks = F.transform(F.array(sizes), lambda s: F.when(s.n < 100, 1).otherwise(0)
                        + F.when(100 * s.d < 80 * s.n, 2).otherwise(0))[0]
    return (masks + F.when(F.lit(100) * capitals > F.lit(10) * F.length(text), 4).otherwise(0)
            + F.when(text.rlike(r"[#$%&*|]"), 8).otherwise(0))


def masks(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask) of each document; bit 4 says that a smaller id has the same text."""
    texts = docs.select("doc_id", "lang", _whole().alias("text"))
    tested = screened(texts)
    name = F.sha2("text", 256)
    marked = written(tested.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), failures(F.col("text")).alias("mask"),
                                   F.when(F.col("maybe"), name).alias("name")), "masks")
    # Equal texts meet on the map side first, so a group of copies is one row a task.
    firsts = (tested.filter("maybe").groupBy("text").agg(F.min("doc_id").alias("doc_id"))
              .select("doc_id", name.alias("name"), F.lit(True).alias("first")))
    alone = marked.filter("name IS NULL OR doc_id IS NULL").select("doc_id", "part", "mask")
    shared = (marked.filter("name IS NOT NULL AND doc_id IS NOT NULL").join(firsts, ["doc_id", "name"], "left")
              .select("doc_id", "part", (F.col("mask") + F.when(F.col("first"), 0).otherwise(16)).alias("mask")))
    return alone.union(shared)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part, order of the five filters and step: see `FILTERS`.

    `docs` has doc_id, text and lang, `labels` doc_id, quality and toxic. kept, removed,
    redundant, unique_fails, good_lost, toxic_lost and shapley count documents of the part.

    A null text is the empty one, a null lang the part "". A row without an id repeats
    no text and has no labels; rows that agree in id and text do not repeat one another.
    Of several labels of one id any quality or toxicity of 1 counts. An empty table has
    no part. Other columns are left out.
    """
    verdicts = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")).filter("good OR toxic")
    counted = masks(docs).join(verdicts, "doc_id", "left").groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))
    # 32 masks a part.
    parts = counted.groupBy("part").agg(F.map_from_entries(F.collect_list(
        F.struct("mask", F.struct("n", "good", "toxic")))).alias("of"))
    every = F.sequence(F.lit(0), F.lit(31))

    def free(what: str) -> Column:
        """For each set of filters, the documents that fail none of them."""
        return F.transform(every, lambda s: F.aggregate(
            F.map_keys("of"), F.lit(0).cast("long"),
            lambda sofar, m: sofar + F.when(m.bitwiseAND(s) == 0, F.col("of")[m][what]).otherwise(0)))

    frees = parts.select("part", *(free(c).alias(c) for c in ("n", "good", "toxic")),
                         F.transform(every, lambda m: F.coalesce(F.col("of")[m]["n"], F.lit(0).cast("long"))).alias("only"))
    steps = frees.withColumn("filter_order", F.explode(F.array(*map(F.lit, ORDERS)))).withColumn(
        "step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    bits = {c: 1 << k for k, c in enumerate(FILTERS)}
    mine = F.expr("substring(filter_order, step, 1)")
    bit = sum((F.when(mine == c, b).otherwise(0) for c, b in bits.items()), F.lit(0))
    ahead = sum((F.when(F.instr("filter_order", c) < F.col("step"), b).otherwise(0) for c, b in bits.items()), F.lit(0))
    steps = steps.withColumns({"bit": bit, "ahead": ahead}).withColumn("after", F.col("ahead") + F.col("bit"))

    def lost(what: str) -> Column:
        return F.get(what, F.col("ahead")) - F.get(what, F.col("after"))

    # Orders in which exactly the filters of a set come before one outside it, by the set's size.
    leading = F.array(*map(F.lit, (24, 6, 4, 6, 24)))
    shapley = F.aggregate(every, F.lit(0).cast("long"), lambda sofar, s: sofar + F.when(
        s.bitwiseAND(F.col("bit")) == 0,
        F.get(leading, F.bit_count(s)) * (F.get("n", s) - F.get("n", s + F.col("bit")))).otherwise(0))
    fails = F.get("n", F.lit(0)) - F.get("n", F.col("bit"))
    return steps.select("part", "filter_order", "step", F.get("n", F.col("after")).alias("kept"), lost("n").alias("removed"),
                        (fails - lost("n")).alias("redundant"), F.get("only", F.col("bit")).alias("unique_fails"),
                        lost("good").alias("good_lost"), lost("toxic").alias("toxic_lost"), shapley.alias("shapley"))


ORACLE = rf"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '{WORD}') AS words, min(doc_id) OVER (PARTITION BY text) AS first FROM d),
l AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
      FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic,
        {{'A': len(words) < 100, 'B': 100 * len(list_distinct(words)) < 80 * len(words),
          'C': 100 * len(regexp_extract_all(text, '[A-Z]')) > 10 * length(text),
          'D': regexp_matches(text, '[#$%&*|]'), 'E': coalesce(doc_id > first, false)}} AS fails
      FROM w LEFT JOIN l USING (doc_id)),
m AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY ALL),
c AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM c a, c b, c c, c d, c e
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, step, filter_order[step] AS x, filter_order[1:step - 1] AS before FROM o, range(1, 6) AS r(step)),
g AS (SELECT part, filter_order, step, x, n, good, toxic,
        (contains(x, 'A') AND fails.A) OR (contains(x, 'B') AND fails.B) OR (contains(x, 'C') AND fails.C)
          OR (contains(x, 'D') AND fails.D) OR (contains(x, 'E') AND fails.E) AS now,
        (contains(before, 'A') AND fails.A) OR (contains(before, 'B') AND fails.B) OR (contains(before, 'C') AND fails.C)
          OR (contains(before, 'D') AND fails.D) OR (contains(before, 'E') AND fails.E) AS earlier,
        fails.A::INT + fails.B::INT + fails.C::INT + fails.D::INT + fails.E::INT AS k FROM m, s),
t AS (SELECT part, filter_order, CAST(step AS INT) AS step, x,
        CAST(coalesce(sum(n) FILTER (NOT now AND NOT earlier), 0) AS BIGINT) AS kept,
        CAST(coalesce(sum(n) FILTER (now AND NOT earlier), 0) AS BIGINT) AS removed,
        CAST(coalesce(sum(n) FILTER (now AND earlier), 0) AS BIGINT) AS redundant,
        CAST(coalesce(sum(n) FILTER (now AND k = 1), 0) AS BIGINT) AS unique_fails,
        CAST(coalesce(sum(good) FILTER (now AND NOT earlier), 0) AS BIGINT) AS good_lost,
        CAST(coalesce(sum(toxic) FILTER (now AND NOT earlier), 0) AS BIGINT) AS toxic_lost
      FROM g GROUP BY part, filter_order, step, x)
SELECT * EXCLUDE (x), CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley FROM t
"""
