"""Markdown documents as rows: criteria, test weights, sections and label forms.

A document is cut at its headings first, inside its own row. A section then
carries its heading with it, so no line is ever sorted or shuffled to learn
which heading it stands under.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from gaugeworks import fixed
from gaugeworks.functions import text as tx

SECTION = "struct<heading:string,first_line:int,lines:array<string>>"


def sections_of(text: Column, heading: str) -> Column:
    """Sections of a text: heading text (null above the first), line number, lines below it.

    A line is a heading where `heading` matches it; its first group is the title.
    """
    # A heading carries the number of the line below it.
    marked = F.transform(tx.lines(text), lambda line, i: F.when(
        line.rlike(heading), F.concat(F.lit("\u0001"), (i + 2).cast("string"), F.lit("\u0001"), line)).otherwise(line))
    parts = F.filter(F.split(F.array_join(marked, "\n"), "(?m)^(?=\u0001)"), lambda p: p != "")
    parts = F.transform(parts, lambda p: F.split(F.regexp_replace(p, "\n$", ""), "\n"))

    def one(rows: Column) -> Column:
        first = F.get(rows, 0)
        opens = first.startswith("\u0001")
        named = F.split(first, "\u0001", 3)
        return F.struct(
            F.when(opens, F.regexp_extract(F.get(named, 2), heading, 1)).alias("heading"),
            F.when(opens, F.get(named, 1).try_cast("int")).otherwise(F.lit(1)).alias("first_line"),
            F.when(opens, F.slice(rows, F.lit(2), F.size(rows))).otherwise(rows).alias("lines"))

    return F.transform(parts, one)


def _lookup(key: Column, table: dict[str, str]) -> Column:
    out = F
    for k, v in table.items():
        out = out.when(key == k, F.lit(v))
    return out


def criteria_lines(documents: DataFrame, key: str, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(criteria, rejected) of criteria documents.

    A criterion is a bullet under a known heading carrying one allowed weight and
    at most one place it is checked in. A line can be rejected for several
    reasons, one row each; an unknown tag is reported and costs the line nothing.
    """
    body = tx.strip_comments(F.col(text))
    secs = documents.select(key, F.explode(sections_of(body, fixed.PLAIN_HEADING)).alias("s"))
    category = _lookup(F.lower(F.trim("s.heading")), fixed.SECTION_CATEGORY)
    headed = secs.select(key, "s.*", category.alias("category"))
    # Everything is told of a line in one pass, its section's heading among them.
    unknown = F.col("heading").isNotNull() & F.col("category").isNull()
    below = F.filter(F.transform("lines", lambda line, i: F.struct(
        (F.col("first_line") + i).alias("line_no"), line.alias("line"))), lambda x: x["line"].rlike(r"\S"))
    above = F.filter(F.array(F.struct((F.col("first_line") - 1).alias("line_no"), F.lit(None).cast("string").alias("line"))), lambda x: unknown)
    rows = headed.select(key, "category", F.explode(F.concat(above, below)).alias("r")).select(
        key, "category", "r.*")
    # Bullets under a known heading are few; the rest is told apart by two cheap tests.
    is_bullet, headless = F.col("line").rlike(fixed.BULLET), F.col("category").isNull()
    stray = F.when(F.col("line").isNull(), "unknown heading").when(~is_bullet, "not a heading or a bullet").when(
        headless, "not under a known heading")
    rows = rows.withColumn("stray", stray)
    bullet = F.when(F.col("stray").isNull(), F.regexp_extract("line", fixed.BULLET, 1))
    prefix = F.regexp_extract(bullet, "(" + fixed.TAG_RUN + ")", 1)
    tagged = rows.select(
        key, "category", "line_no", "stray", F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(
            prefix, F.lit(fixed.ONE_TAG), F.lit(1)), F.lower))).alias("tags"),
        tx.strip(F.regexp_replace(bullet, fixed.TAG_RUN, "")).alias("criteria"))
    numeric = lambda t: t.rlike(r"^[+-]?\d+$")
    values = F.transform(F.filter("tags", numeric), lambda t: t.cast("int"))
    allowed = F.filter(values, lambda v: v.isin(*fixed.WEIGHTS))
    known = (*fixed.STATE_TAGS, *fixed.USER_TAGS, *fixed.LEGACY_TAGS, "negative")
    has = lambda names: F.exists("tags", lambda t: t.isin(*names))
    legacy = F.when(has(["must"]), 5).when(has(["should"]), 1).when(has(["negative"]), 5)
    legacy = F.when(has(["negative"]), -legacy).otherwise(legacy)
    read = tagged.select(
        key, "category", "line_no", "stray", "criteria",
        F.coalesce(F.try_element_at(allowed, F.lit(-1)), legacy).alias("weight"),
        (F.size(values) > F.size(allowed)).alias("_off"),
        F.exists("tags", lambda t: ~numeric(t) & ~t.isin(*known)).alias("_unknown"),
        has(fixed.STATE_TAGS).alias("_state"), has(fixed.USER_TAGS).alias("_user"))
    both, no_weight = F.col("_state") & F.col("_user"), F.col("weight").isNull()
    problems = F.array_compact(F.array(
        F.when(F.col("_off"), "weight not allowed"), F.when(F.col("_unknown"), "unknown tag"),
        F.when(both, "checked in two places"),
        F.when(~both & no_weight & ~F.col("_off"), "no weight"),
        F.when(~both & ~no_weight & (F.col("criteria") == ""), "no text")))
    kept = read.where(F.col("stray").isNull() & ~both & ~no_weight & (F.col("criteria") != "")).select(
        key, "line_no", "category", "weight", "criteria",
        F.array(_lookup(F.col("category"), fixed.LABEL_OF_CATEGORY),
                F.when(F.col("_state"), fixed.STATE_CHANGE).otherwise(fixed.USER_FACING)).alias("type"),
        F.md5("criteria").alias("criterion_id"))
    rejected = read.select(key, "line_no", F.explode(F.when(F.col("stray").isNotNull(), F.array("stray")).otherwise(
        problems)).alias("problem"))
    return kept, rejected


def test_weight_lines(documents: DataFrame, key: str, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(weights, rejected) of test weight lists; a name listed again is rejected."""
    rows = (documents.select(key, F.posexplode(tx.lines(F.col(text))).alias("_i", "line"))
            .select(key, (F.col("_i") + 1).alias("line_no"), tx.strip(F.col("line")).alias("line"))
            .where(F.col("line").startswith("- [")))
    read = rows.select(key, "line_no", F.regexp_extract("line", fixed.WEIGHT_ENTRY, 1)
                       .try_cast("int").alias("weight"),
                       F.regexp_extract("line", fixed.WEIGHT_ENTRY, 2).alias("name"))
    off = F.when(F.col("weight").isNull(), "cannot read").when(
        ~F.col("weight").isin(*fixed.TEST_WEIGHTS), "weight not allowed")
    read = read.withColumn("problem", off)
    place = Window.partitionBy(key, "name").orderBy("line_no")
    good = read.where("problem IS NULL").withColumn("_rn", F.row_number().over(place))
    twice = good.where("_rn > 1").select(key, "line_no", F.lit("listed twice").alias("problem"))
    return (good.where("_rn = 1").select(key, "name", "weight"),
            read.where("problem IS NOT NULL").select(key, "line_no", "problem").unionByName(twice))


def purpose_sections(documents: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(section, text) of each document by what its headings say, in a fixed precedence.

    Sections of one purpose are run together in their order; an unrecognised
    heading is its own section under its lower-cased title.
    """
    def purpose(title: Column) -> Column:
        low, out = F.lower(title), F.when(title.isNull(), F.lit("preamble"))
        for name, words in fixed.SECTION_WORDS:
            test = F.lit(False)
            for w in words:
                test = test | low.contains(w)
            out = out.when(test, F.lit(name))
        return out.otherwise(low)

    secs = F.transform(sections_of(F.col(text), fixed.SECTION_HEADING), lambda s: F.struct(
        purpose(s["heading"]).alias("section"), F.array_join(s["lines"], "\n").alias("text")))
    held = documents.select(key, secs.alias("secs"))
    names = F.array_distinct(F.transform("secs", lambda s: s["section"]))
    return (held.withColumn("section", F.explode(names))
            .select(key, "section", F.array_join(F.transform(F.filter(
                "secs", lambda s: s["section"] == F.col("section")), lambda s: s["text"]), "")
                .alias("text")))


def sealed_digest(sections: DataFrame, key: str) -> DataFrame:
    """A digest of each document's sealed sections, comments and empty ones out."""
    body = tx.strip(tx.strip_comments(F.col("text")))
    held = sections.where(F.col("section").isin("answer", "derivation", "unknowable")).select(
        key, "section", body.alias("text")).where("text <> ''")
    return held.groupBy(key).agg(F.sha2(F.to_json(F.array_sort(F.collect_list(
        F.struct("section", "text")))), 256).alias("sealed_sha256"))


def label_forms(documents: DataFrame, key: str, text: str = "text") -> DataFrame:
    """The five answers of each label form, and what is wrong with it.

    Comments keep their line breaks, so that line numbers stay true. A field that
    is missing, given twice, or spelled another way is a problem and has no value.
    """
    body = F.regexp_replace(F.col(text), fixed.COMMENT, "")
    norm = lambda t: F.trim(F.regexp_replace(F.regexp_replace(F.lower(t), r"[?: ]+$", ""), r"\s+", " "))
    secs = F.transform(sections_of(body, fixed.HEADING), lambda s: F.struct(
        norm(s["heading"]).alias("heading"),
        F.filter(s["lines"], lambda x: x.rlike(r"\S")).alias("lines")))
    held = documents.select(key, secs.alias("secs"))
    problem = lambda field, what: F.struct(F.lit(field).alias("field"), F.lit(what).alias("what"))
    known = [norm(F.lit(h)) for _, h, _ in fixed.LABEL_FIELDS]
    stray = F.exists("secs", lambda s: s["heading"].isNull() & (F.size(s["lines"]) > 0))
    other = F.exists("secs", lambda s: s["heading"].isNotNull() & ~s["heading"].isin(*known))
    problems = [F.when(stray, problem("file", "text above the first heading")),
                F.when(other, problem("file", "unknown heading"))]
    columns = []
    for name, heading, kind in fixed.LABEL_FIELDS:
        wanted = norm(F.lit(heading))
        mine = F.filter("secs", lambda s: s["heading"] == wanted)  # noqa: B023
        entries = F.get(mine, 0)["lines"]
        value, bad = _label_value(entries, kind)
        problems += [F.when(F.size(mine) == 0, problem(name, "heading missing")),
                     F.when(F.size(mine) > 1, problem(name, "heading given twice")),
                     F.when((F.size(mine) > 0) & bad, problem(name, "not an accepted answer"))]
        columns.append(value.alias(name))
    return held.select(key, *columns, F.array_compact(F.array(*problems)).alias("problems"))


def _answer(raw: Column) -> Column:
    """An answer's spelling folded: trailing marks off, dashes one kind, lower case."""
    bare = F.regexp_replace(tx.strip(raw), r"[.,;:!]+$", "")
    low = F.translate(F.lower(bare), tx.DASHES, "-" * len(tx.DASHES))
    return F.trim(F.regexp_replace(low, r"\s+", " "))


def level_of(raw: Column) -> Column:
    parts = r"^(?:l|level)\s*([1-5])\s*-\s*([a-z]+)$"
    found = F.concat(F.lit("l"), F.regexp_extract(_answer(raw), parts, 1), F.lit(" - "),
                     F.regexp_extract(_answer(raw), parts, 2))
    return F.when(found.isin(*fixed.LEVELS), found)


def failure_category_of(raw: Column) -> Column:
    found = F.regexp_replace(_answer(raw), r"\s*/\s*|\s+", "_")
    return F.when(found.isin(*fixed.FAILURE_CATEGORIES), found)


def _label_value(entries: Column, kind: str) -> tuple[Column, Column]:
    filled = F.coalesce(F.size(entries) > 0, F.lit(False))
    one = F.get(entries, 0)
    if kind == "prose":
        return F.when(filled, tx.prose(F.array_join(entries, "\n"))), F.lit(False)
    if kind == "categories":
        items = F.filter(F.flatten(F.transform(entries, lambda x: F.split(x, ","))),
                         lambda p: p.rlike(r"\S"))
        read = F.transform(items, failure_category_of)
        bad = F.coalesce(F.exists(read, lambda r: r.isNull()), F.lit(False))
        return F.when(filled & ~bad, F.array_distinct(read)), filled & bad
    value = level_of(one) if kind == "level" else F.when(_answer(one).isin("yes", "no"), _answer(one))
    good = filled & (F.size(entries) == 1) & value.isNotNull()
    return F.when(good, value), filled & ~good
