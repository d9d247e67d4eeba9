"""Personal data in texts: base rules, and identifiers found by bootstrapped context patterns.

Base rules find e-mail addresses, IP addresses, card and telephone numbers. What they
find are seeds. The words around a seed are patterns; a pattern is trusted by the share
of its distinct instances that are known, an instance by the mean trust of its patterns,
in rounds over the graph of both. Where a trusted pattern stands around an identifier no
rule knows, the identifier is personal data as well.

Built-in functions only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.store import written

KINDS = ("email", "ip", "card", "phone")
#: Leftmost matches as of the plain rules. Parts that cannot match otherwise are possessive, and a run that
#: failed from its start is not tried from its middle, so time is linear in the text.
_LOCAL = r"[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
IP = rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"
_GAP, _SOLID = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"
#: What can identify somebody: a number in groups or a word with a digit or an at sign.
IDENTIFIER = (rf"(?<!{_SOLID})(?:\+[0-9][\x20().0-9-]+[0-9]|[0-9]++(?:[\x20-][0-9]++)++"
              rf"|[^\x20\x09-\x0D0-9@]*+[0-9@]{_SOLID}*+)")
_HEAD, _TAIL = r"^[^\p{L}\p{N}+]++", r"(?<=[\p{L}\p{N}])[^\p{L}\p{N}]++$"
#: A trusted pattern has so many distinct seeds of its kind, and at least this trust.
LEAST_SEEDS, TRUST = 3, 0.7
#: Instances counted against every pattern, so that few seeds alone are not trusted.
DOUBT = 1.0
ROUNDS = 3


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once a row, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def _sums_before(steps: Column) -> Column:
    """For each number of an array the sum of those before it, by sums of blocks of root length."""
    zero = F.lit(0).cast("int")

    def added(numbers: Column, start, length) -> Column:
        return F.aggregate(F.slice(numbers, start, length), zero, lambda a, x: a + x)

    def of_width(w: Column) -> Column:
        count = F.greatest(F.lit(0), (F.size(steps) - 1) / w).cast("int")
        blocks = F.transform(F.sequence(zero, count), lambda k: added(steps, k * w + 1, w))
        return _let(blocks, lambda b: _let(F.transform(b, lambda _, k: added(b, F.lit(1), k)), lambda ahead: F.transform(
            steps, lambda _, i: F.get(ahead, (i / w).cast("int")) + added(steps, (i - i % w + 1).cast("int"), i % w))))
    return _let(F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(steps))).cast("int")), of_width)


def located(text: Column, pattern: str) -> Column:
    """(m, s, e, before, after) of all matches: text, start and end in code points, and the texts up to the next matches."""
    both = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.split(text, pattern, -1).alias("gaps"))

    def placed(found: Column) -> Column:
        steps = F.transform(found.m, lambda m, i: F.length(F.get(found.gaps, i)) + F.length(m))
        return _let(steps, lambda step: _let(_sums_before(step), lambda ahead: F.transform(found.m, lambda m, i: F.struct(
            m.alias("m"), (F.get(ahead, i) + F.length(F.get(found.gaps, i))).alias("s"), (F.get(ahead, i) + F.get(step, i)).alias("e"),
            F.get(found.gaps, i).alias("before"), F.get(found.gaps, i + 1).alias("after")))))
    return _let(both, placed)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]++", "")


def _holds(kind: str, m: Column) -> Column:
    """Whether a match counts."""
    size = F.length(_digits(m))
    if kind == "ip":
        return m.rlike(IP)
    if kind == "card":
        return size.between(13, 19) & F.call_function("luhn_check", _digits(m))
    return size.between(9, 15) if kind == "phone" else F.lit(True)


def base_spans(text: Column) -> Column:
    """array of (k, s, e) by kind and start; k is the kind's place in KINDS."""
    none = F.array().cast("array<struct<k:int,s:int,e:int>>")
    hints = {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+")), "ip": text.rlike("[0-9]"),
             "card": text.rlike("[0-9]")}

    def spans(k: int, kind: str) -> Column:
        kept = F.filter(located(text, PATTERNS[kind]), lambda x: _holds(kind, x.m))
        return F.when(hints[kind], F.transform(kept, lambda x: F.struct(
            F.lit(k).alias("k"), x.s.alias("s"), x.e.alias("e")))).otherwise(none)
    return F.concat(*(spans(k, kind) for k, kind in enumerate(KINDS)))


def _kind(m: Column) -> Column:
    """The kind whose rule holds for an identifier by itself; null where none does."""
    cards, phones = (F.regexp_extract(m, PATTERNS[k], 0) for k in ("card", "phone"))
    return (F.when(m.rlike(PATTERNS["email"]), 0).when(F.regexp_extract(m, PATTERNS["ip"], 0).rlike(IP), 1)
            .when(_holds("card", cards), 2).when((phones != "") & _holds("phone", phones), 3).cast("int"))


def identifiers(text: Column) -> Column:
    """array of (inst, kind, s, e, patterns) of everything in the text that looks like an identifier.

    Patterns are the two words before, and the word before with the word after; small letters, digits
    as 0. "^" stands for the end of the text, or for another identifier.
    """
    def seen(x: Column) -> Column:
        before, after = F.regexp_replace(F.lower(x.before), "[0-9]", "0"), F.regexp_replace(F.lower(x.after), "[0-9]", "0")
        last = F.regexp_extract(before, rf"(?<!{_SOLID})({_SOLID}++){_GAP}*+$", 1)
        two = F.regexp_extract(before, rf"(?<!{_SOLID})({_SOLID}++{_GAP}++{_SOLID}++){_GAP}*+$", 1)
        first = F.regexp_extract(after, rf"^{_GAP}*+({_SOLID}++)", 1)
        end = F.lit("^")
        near, far = F.when(last == "", end).otherwise(last), F.when(first == "", end).otherwise(first)
        # Where no word stands before, nothing speaks for what follows.
        patterns = F.when(last == "", F.array().cast("array<string>")).otherwise(F.array(
            F.concat(F.lit("<"), F.when(two == "", F.concat(end, F.lit(" "), last)).otherwise(
                F.regexp_replace(two, f"{_GAP}++", " "))),
            F.concat(F.lit("|"), near, F.lit(" "), far)))
        lead = F.length(x.m) - F.length(F.regexp_replace(x.m, _HEAD, ""))
        bare = F.regexp_replace(F.regexp_replace(x.m, _HEAD, ""), _TAIL, "")
        return _let(bare, lambda b: F.struct(
            F.lower(b).alias("inst"), _kind(b).alias("kind"), (x.s + lead).alias("s"), (x.s + lead + F.length(b)).alias("e"),
            patterns.alias("patterns")))
    found = F.transform(located(text, IDENTIFIER), seen)
    return F.filter(found, lambda x: x.e > x.s)


def trusted(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(pattern, k, trust): the trusted patterns of the graph (pattern, inst, kind), its edges distinct.

    Seeds keep a score of 1 for their kind. In each round a pattern has the sum of its instances' scores
    over their number and DOUBT, another instance the mean over its patterns.
    """
    size = edges.groupBy("pattern").agg(F.count("*").alias("size"))
    degree = edges.filter("kind IS NULL").groupBy("inst").agg(F.count("*").alias("degree"))
    known = edges.filter("kind IS NOT NULL")
    seeds = written(known.groupBy("pattern", F.col("kind").alias("k")).agg(F.count("*").alias("seeds"))
                    .join(size, "pattern"), "seeds")
    patterns = seeds.select("pattern", "k", "seeds", "size", (F.col("seeds") / (F.col("size") + DOUBT)).alias("trust"))
    # Only instances without a kind move; those of patterns without any seed stay at 0.
    open_edges = written(edges.filter("kind IS NULL").select("pattern", "inst").join(seeds.select("pattern").distinct(), "pattern"), "open")
    for _ in range(rounds):
        scores = (open_edges.join(patterns.select("pattern", "k", "trust"), "pattern").groupBy("inst", "k")
                  .agg(F.sum("trust").alias("sum")).join(degree, "inst")
                  .select("inst", "k", (F.col("sum") / F.col("degree")).alias("score")))
        gained = open_edges.join(scores, "inst").groupBy("pattern", "k").agg(F.sum("score").alias("gained"))
        patterns = written(seeds.join(gained, ["pattern", "k"], "left").select(
            "pattern", "k", "seeds", "size",
            ((F.col("seeds") + F.coalesce("gained", F.lit(0.0))) / (F.col("size") + DOUBT)).alias("trust")), "patterns")
    return patterns.filter((F.col("seeds") >= LEAST_SEEDS) & (F.col("trust") >= TRUST)).groupBy("pattern").agg(
        F.max_by("k", F.struct(F.col("trust"), -F.col("k"))).alias("k"), F.max("trust").alias("trust"))


def personal(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans and n_found of each document of (doc_id, text).

    The counts and the digest are those of the base rules; spans has these and, with the kind of the
    pattern that found them, n_found more. A found span overlaps no base span.

    A null or empty text has no spans. Ids may be null or repeated; rows equal in id and text get equal
    results. An empty table gives an empty result. Other columns are left out.
    """
    whole = F.coalesce("text", F.lit(""))
    looks = F.when(whole.rlike("[0-9@]"), identifiers(whole)).otherwise(
        F.array().cast("array<struct<inst:string,kind:int,s:int,e:int,patterns:array<string>>>"))
    rows = written(docs.select("doc_id", F.xxhash64(whole).alias("same"), base_spans(whole).alias("base"), looks.alias("ids")),
                   "personal")
    seen = rows.select("doc_id", "same", "base", F.explode("ids").alias("x")).select("doc_id", "same", "base", "x.*")
    edges = written(seen.select("inst", "kind", F.explode("patterns").alias("pattern")).groupBy("pattern", "inst").agg(
        F.max("kind").alias("kind")), "edges")
    good = written(trusted(edges), "trusted")
    apart = ~F.exists("base", lambda b: (b.s < F.col("e")) & (b.e > F.col("s")))
    unseen = (seen.filter(F.col("kind").isNull() & apart).select("doc_id", "same", "s", "e", F.explode("patterns").alias("pattern"))
              .join(good, "pattern").groupBy("doc_id", "same", "s", "e")
              .agg(F.max_by("k", F.struct(F.col("trust"), -F.col("k"))).alias("k")))
    # At most the identifiers of one text.
    more = unseen.groupBy("doc_id", "same").agg(F.collect_list(F.struct("k", "s", "e")).alias("more"))
    both = rows.drop("ids").alias("r").join(more.alias("m"), F.col("r.doc_id").eqNullSafe(F.col("m.doc_id"))
                                            & (F.col("r.same") == F.col("m.same")), "left").select(
        "r.doc_id", "base", F.coalesce("more", F.array().cast("array<struct<k:int,s:int,e:int>>")).alias("more"))

    def joined(spans: Column) -> Column:
        names = F.array(*map(F.lit, KINDS))
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x.k), x.s, x.e)), ",")

    def counted(k: int) -> Column:
        return F.size(F.filter("base", lambda x: x.k == k)).cast("long").alias(f"n_{KINDS[k]}")
    counts = [counted(k) for k in range(len(KINDS))]
    return both.select("doc_id", *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                       joined(F.array_sort(F.concat("base", "more"))).alias("spans"),
                       F.size("more").cast("long").alias("n_found"))
