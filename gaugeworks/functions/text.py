"""Sentences, words, paths and spelling folds over text columns."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

from gaugeworks import fixed

DASHES = "‐‑‒–—―−"
QUOTES = "‘’“”"


# Rows of a batch that are Python strings at one time.
SLICE_ROWS = 64


@F.arrow_udf(StringType())
def _nfkd(text: pa.Array) -> pa.Array:
    parts = [pa.array([], pa.string())]
    for lo in range(0, len(text), SLICE_ROWS):
        parts.append(pa.array([None if s is None else unicodedata.normalize("NFKD", s)
                               for s in text.slice(lo, SLICE_ROWS).to_pylist()], pa.string()))
    return pa.concat_arrays(parts)


def normalise(text: Column, compatibility: bool = True) -> Column:
    """Case, dashes, quotes and white space folded so that two spellings meet.

    `compatibility=False` skips the NFKD step (the one thing here the JVM has no
    function for) where the text is known to be ASCII.
    """
    base = F.coalesce(text, F.lit(""))
    if compatibility:  # only texts with anything beyond ASCII leave the JVM
        base = F.coalesce(_nfkd(F.when(F.octet_length(base) != F.length(base), base)), base)
    base = F.translate(base, DASHES, "-" * len(DASHES))
    base = F.translate(base, QUOTES, "'" * len(QUOTES))
    return F.lower(F.trim(F.regexp_replace(base, r"(?U)\s+", " ")))


def strip(text: Column) -> Column:
    """Both ends without white space of any kind."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def squeeze(text: Column) -> Column:
    """Runs of white space as one blank, ends trimmed."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))


def lines(text: Column) -> Column:
    return F.split(text, fixed.LINE_BREAK)


def sentences(text: Column) -> Column:
    """Sentences: per line first, then after a full stop, a bang or a question mark."""
    pieces = F.flatten(F.transform(
        lines(text), lambda line: F.split(strip(line), r"(?<=[.!?])\s+")))
    return F.filter(F.transform(pieces, lambda s: strip(s)), lambda s: s != "")


def quote_for(text: Column, needle: Column) -> Column:
    """The first sentence holding `needle`, at most 300 characters; else the needle."""
    first = F.get(F.filter(sentences(text), lambda s: s.contains(needle)), 0)
    cut = F.when(F.length(first) <= fixed.QUOTE_CHARS, first).otherwise(
        F.concat(F.substring(first, 1, fixed.QUOTE_CHARS - 3), F.lit("...")))
    return F.coalesce(cut, needle)


def prose(text: Column) -> Column:
    """Comments out, the lines of a paragraph joined, paragraphs one blank line apart."""
    body = F.regexp_replace(F.coalesce(text, F.lit("")), fixed.COMMENT, "")
    # A named F.trim would get the line's place as the characters to trim.
    marked = F.array_join(F.transform(lines(body), lambda line: F.trim(line)), "\n")
    paragraphs = F.split(marked, "\n\n+")
    joined = F.transform(paragraphs, lambda p: F.trim(F.replace(p, F.lit("\n"), F.lit(" "))))
    return F.array_join(F.filter(joined, lambda p: p != ""), "\n\n")


def word_count(text: Column) -> Column:
    squeezed = squeeze(text)
    return F.when(squeezed == "", F.lit(0)).otherwise(F.size(F.split(squeezed, " ")))


def paragraph_count(text: Column) -> Column:
    body = prose(text)
    return F.when(body == "", F.lit(0)).otherwise(F.size(F.split(body, "\n\n")))


def sentence_count(text: Column) -> Column:
    """How many sentences a piece of prose holds, abbreviations and initials aside.

    A boundary counts unless the word before it is a known abbreviation or a
    single letter.
    """
    body = squeeze(prose(text))
    marked = F.regexp_replace(body, "[.!?]+[\"')\\]]*\\s+(?=[A-Z0-9\"'(\\[])", "\u0001")
    before = F.slice(F.split(marked, "\u0001"), 1,
                     F.greatest(F.size(F.split(marked, "\u0001")) - 1, F.lit(0)))
    last_words = F.transform(before, lambda part: F.lower(F.regexp_replace(
        F.element_at(F.split(part, " "), -1), "^[(\"'\\[]+", "")))
    ends = F.filter(last_words, lambda w: ~w.isin(*fixed.ABBREVIATIONS)
                    & ~w.rlike("^[a-z]$"))
    return F.when(body == "", F.lit(0)).otherwise(F.size(ends) + 1)


def paths_in(text: Column) -> Column:
    """Distinct file-looking tokens, leading and trailing dots and slashes removed."""
    found = F.regexp_extract_all(text, F.lit(fixed.PATH), F.lit(0))
    cleaned = F.transform(found, lambda p: F.regexp_replace(p, r"^[./]+|[./]+$", ""))
    return F.array_distinct(F.filter(cleaned, lambda p: p != ""))


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def suffix(path: Column) -> Column:
    """The lower-cased suffix of a path, empty where its name carries none."""
    return F.lower(F.regexp_extract(base_name(path), r"^.+(\.[^.]+)$", 1))


def drop_encoded(text: Column) -> Column:
    """Long runs of encoded bytes replaced by a short note."""
    return F.regexp_replace(text, fixed.ENCODED_RUN, F.lit(fixed.IMAGE_NOTE))


def strip_comments(text: Column) -> Column:
    return F.regexp_replace(text, fixed.COMMENT, "")


def quoted_in(claim_norm: Column, source_norm: Column) -> Column:
    """Whether a normalised quotation is in a normalised source.

    Longer ones are held to their first six words only.
    """
    words = F.split(claim_norm, " ")
    opening = F.array_join(F.slice(words, 1, 6), " ")
    return (claim_norm != "") & (
        source_norm.contains(claim_norm)
        | ((F.size(words) > 6) & source_norm.contains(opening)))


def named_in(part_norm: Column, text_norm: Column) -> Column:
    """Quoted in the text, or a third of its content words shared with it."""
    have = F.array_distinct(F.regexp_extract_all(text_norm, F.lit(fixed.WORD_TOKEN), F.lit(0)))
    want = F.filter(
        F.array_distinct(F.regexp_extract_all(part_norm, F.lit(fixed.WORD_TOKEN), F.lit(0))),
        lambda w: ~w.isin(*fixed.WORDING_STOP))
    shared = F.size(F.array_intersect(want, have))
    return quoted_in(part_norm, text_norm) | ((shared > 0) & (shared * 3 >= F.size(want)))


def _stem(word: Column) -> Column:
    bare = F.regexp_replace(word, "[.-]+$", "")
    return (
        F.when(bare.endswith("ies") & (F.length(bare) > 4),
               F.concat(bare.substr(F.lit(1), F.length(bare) - 3), F.lit("y")))
        .when(bare.endswith("s") & ~bare.endswith("ss") & (F.length(bare) > 3),
              bare.substr(F.lit(1), F.length(bare) - 1))
        .otherwise(bare))


def wording(text_norm: Column) -> Column:
    """Content words of a normalised line: plurals folded, figures left out."""
    tokens = F.regexp_extract_all(text_norm, F.lit(fixed.WORD_TOKEN), F.lit(0))
    bare = F.transform(tokens, lambda w: F.regexp_replace(w, "[.-]+$", ""))
    kept = F.filter(bare, lambda w: ~w.isin(*fixed.WORDING_STOP) & (F.length(w) > 2)
                    & ~w.rlike("[0-9]"))
    return F.array_distinct(F.transform(kept, _stem))


def marks(text: Column) -> Column:
    """Identifiers mixing letters and digits, and figures."""
    from gaugeworks.functions.numbers import figures_in

    tokens = F.regexp_extract_all(text, F.lit(fixed.IDENTIFIER_TOKEN), F.lit(0))
    mixed = F.filter(tokens, lambda w: w.rlike("[0-9]") & w.rlike(r"\p{L}"))
    return F.array_union(F.transform(mixed, F.lower), figures_in(text))


def content_words(text: Column) -> Column:
    """The words and canonical figures a suggested line turns on."""
    from gaugeworks.functions.numbers import canonical_number

    tokens = F.regexp_extract_all(F.lower(text), F.lit(fixed.CONTENT_TOKEN), F.lit(0))
    kept = F.filter(tokens, lambda w: ~w.isin(*fixed.FILLER_WORDS)
                    & ((F.length(w) >= 3) | w.rlike("^[0-9]+$")))
    return F.array_distinct(F.transform(
        kept, lambda w: F.when(w.rlike("^(?:" + fixed.NUMBER + ")$"), canonical_number(w))
        .otherwise(w)))


def _let(value: Column, body) -> Column:
    """`body` of a value that is computed once a row, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def words_changed(before: Column, after: Column, most: int | None = None) -> Column:
    """The least number of words to add, drop or replace to make one text of the other.

    Words both begin or end with are left out first. What is between becomes one sign
    a word, the distance of signs is the JVM's own; with `most` it stops beyond that
    and the result is null.
    """
    def split(text: Column) -> Column:
        return F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: w != "")

    def shared(x: Column, y: Column) -> Column:
        """How many words both arrays begin with."""
        n = F.least(F.size(x), F.size(y))
        same = F.zip_with(F.slice(x, 1, n), F.slice(y, 1, n), lambda v, w: v == w)
        return F.coalesce(F.nullif(F.array_position(same, False), F.lit(0)) - 1, n).cast("int")

    def without(x: Column, n: Column) -> Column:
        """The array from its end to behind its first n words."""
        return F.reverse(F.slice(x, n + 1, F.greatest(F.size(x) - n, F.lit(0))))

    def trimmed(p: Column) -> Column:
        return _let(shared(p.x, p.y), lambda n: F.struct(without(p.x, n).alias("x"), without(p.y, n).alias("y")))

    def signs(words: Column, known: Column) -> Column:
        return F.array_join(F.transform(words, lambda w: F.decode(F.unhex(F.lpad(
            F.hex(F.array_position(known, w) + 0xFFFF), 8, "0")), "UTF-32")), "")

    def distance(p: Column) -> Column:
        sides = _let(F.array_union(p.x, p.y), lambda known: F.struct(signs(p.x, known).alias("x"), signs(p.y, known).alias("y")))
        if most is None:
            return _let(sides, lambda q: F.levenshtein(q.x, q.y))
        near = F.abs(F.size(p.x) - F.size(p.y)) <= most
        return F.when(near, F.nullif(_let(sides, lambda q: F.levenshtein(q.x, q.y, most)), F.lit(-1)))
    both = F.struct(split(before).alias("x"), split(after).alias("y"))
    return _let(both, lambda p: _let(trimmed(p), lambda q: _let(trimmed(q), distance))).cast("bigint")


def lint_words(body: Column) -> Column:
    """Content words of a criterion with its exact values taken out."""
    plain = F.regexp_replace(F.lower(body), fixed.EXACT_VALUE, " ")
    tokens = F.regexp_extract_all(plain, F.lit(fixed.LINT_TOKEN), F.lit(0))
    bare = F.transform(tokens, lambda w: F.regexp_replace(w, "[.-]+$", ""))
    return F.array_distinct(F.filter(
        bare, lambda w: ~w.isin(*fixed.LINT_STOP) & (F.length(w) > 2)))


def middle_cut(text: Column, budget: int) -> Column:
    """A text over the budget keeps half of it at each end and says what went."""
    half = budget // 2
    gone = (F.length(text) - budget).cast("string")
    cut = F.concat(F.substring(text, 1, half), F.lit("\n\n... ["), gone,
                   F.lit(" characters omitted from the middle] ...\n\n"), F.right(text, F.lit(half)))
    return F.when(F.length(text) > budget, cut).otherwise(text)


def authority_phrases(text: Column) -> Column:
    """Phrases that settle nothing on their own, each once whatever its case."""
    found = F.regexp_extract_all(strip_comments(text), F.lit(fixed.AUTHORITY), F.lit(0))
    return F.array_distinct(F.transform(found, F.lower))


def hosts_in(text: Column) -> Column:
    """Hosts of the addresses in a text, infrastructure left out."""
    found = F.regexp_extract_all(text, F.lit(fixed.SUBURL), F.lit(1))
    return F.array_except(F.array_distinct(F.transform(found, F.lower)),
                          F.array(*[F.lit(h) for h in fixed.INFRASTRUCTURE_HOSTS]))


def model_name(name: Column) -> Column:
    """A model's name without its provider prefix, lower-cased."""
    return F.lower(F.element_at(F.split(F.trim(name), "/"), -1))


def model_family(name: Column) -> Column:
    """Versions of one model share a family."""
    bare = F.regexp_replace(model_name(name), r"\[.*\]$", "")
    bare = F.regexp_replace(bare, r"-\d{8}$", "")
    parts = F.split(bare, "-")
    return (F.when(bare.startswith("claude-"), F.array_join(F.slice(parts, 1, 2), "-"))
            .when(bare.contains("gemini"), F.lit("gemini"))
            .when(bare.startswith("gpt"), F.lit("gpt"))
            .otherwise(F.element_at(parts, 1)))


def mentions(text: Column, path: Column) -> Column:
    """Whether prose names a file by its path or its bare name, whatever the case."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return low.contains(F.lower(path)) | low.contains(F.lower(base_name(path)))
