"""Figures in text: finding them and writing each one way."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from gaugeworks import fixed


def canonical_number(raw: Column) -> Column:
    """One spelling per number: separators dropped, whole values as integers.

    Other values keep six decimals with trailing zeros removed. A token that is
    no finite number is compared as written.
    """
    text = F.regexp_replace(F.replace(raw, F.lit(","), F.lit("")), r"^\++", "")
    value = text.try_cast("double")
    whole = (value == F.floor(value)) & (F.abs(value) < F.lit(1e15))
    small = F.regexp_replace(
        F.round(value, 6).cast("decimal(38,6)").cast("string"), "0+$", "")
    small = F.when(small.endswith("."), F.concat(small, F.lit("0"))).otherwise(small)
    return (
        F.when(value.isNull(), text)
        .when(F.isnan(value) | (F.abs(value) == F.lit(float("inf"))), F.lower(text))
        .when(whole, value.cast("bigint").cast("string"))
        .when(F.abs(value) >= F.lit(1e16), F.replace(F.replace(
            value.cast("string"), F.lit(".0E"), F.lit("E")), F.lit("E"), F.lit("e+")))
        .when(F.abs(value) >= F.lit(1e15), F.concat(value.cast("bigint").cast("string"), F.lit(".0")))
        .otherwise(small)
    )


def number_tokens(text: Column) -> Column:
    """Every number as written, identifiers and list commas left alone."""
    return F.regexp_extract_all(text, F.lit(fixed.NUMBER), F.lit(0))


def numbers_in(text: Column) -> Column:
    """The distinct canonical numbers of a text."""
    return F.array_distinct(F.transform(number_tokens(text), canonical_number))


def interesting(value: Column) -> Column:
    """Large enough to be worth tracing; smaller figures are counts and footnotes."""
    return F.abs(value.try_cast("double")) >= F.lit(float(fixed.MIN_INTERESTING))


def figures_in(text: Column) -> Column:
    """The distinct figures of a criterion line, single digits left out."""
    tokens = F.regexp_extract_all(text, F.lit(fixed.FIGURE), F.lit(0))
    wide = F.filter(tokens, lambda t: (F.length(t) > 1) | t.contains("."))
    return F.array_distinct(F.transform(wide, lambda t: F.replace(t, F.lit(","), F.lit(""))))


def stated_values(body: Column) -> Column:
    """The exact values a line states; a named ratio such as 260/280 is no value."""
    plain = F.regexp_replace(body, fixed.RATIO_NAME, " ")
    return F.array_distinct(F.regexp_extract_all(plain, F.lit(fixed.EXACT_VALUE), F.lit(0)))
