"""Reading loosely shaped JSON records through VARIANT columns.

Alternatives are tried inside one lambda over an array of them, which keeps the
expression tree small however many keys a dialect may use.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

NO_VARIANTS = "array<variant>"


def field(value: Column, key: str) -> Column:
    return F.try_variant_get(value, f"$.{key}", "variant")


def fields(value: Column, keys) -> Column:
    return F.array(*[field(value, k) for k in keys])


def is_text(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value) == "STRING", F.lit(False))


def is_object(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))


def as_text(value: Column) -> Column:
    """A string value, null for anything else."""
    return F.when(is_text(value), F.try_variant_get(value, "$", "string"))


def shown(value: Column) -> Column:
    """A value as text, objects as JSON; null where empty."""
    return F.nullif(F.nullif(F.nullif(F.try_variant_get(value, "$", "string"), F.lit("")),
                             F.lit("{}")), F.lit("[]"))


def listed(value: Column) -> Column:
    return F.coalesce(F.try_variant_get(value, "$", NO_VARIANTS), F.array().cast(NO_VARIANTS))


def items(value: Column) -> Column:
    """A list's elements, a single object as a list of one, nothing as an empty list."""
    return F.coalesce(F.try_variant_get(value, "$", NO_VARIANTS),
                      F.when(is_object(value), F.array(value)), F.array().cast(NO_VARIANTS))


def first_shown(value: Column, keys) -> Column:
    return F.get(F.array_compact(F.transform(fields(value, keys), shown)), 0)


def first_value(value: Column, keys) -> Column:
    """The first value that is not empty, as a variant."""
    return F.get(F.filter(fields(value, keys), lambda v: shown(v).isNotNull()), 0)


def first_text(value: Column, keys) -> Column:
    """The first string that is not blank, its ends stripped."""
    stripped = F.transform(fields(value, keys), lambda v: F.regexp_replace(
        as_text(v), r"(?U)^\s+|\s+$", ""))
    return F.get(F.filter(stripped, lambda s: s != ""), 0)


def _object_prose(value: Column) -> Column:
    held = F.transform(fields(value, ("text", "content", "message")), as_text)
    return F.coalesce(F.get(F.filter(held, lambda t: t.rlike(r"(?U)\S")), 0), F.lit(""))


def prose_of(value: Column) -> Column:
    """The prose of a content field: a string, an object, or a list of blocks.

    Blocks of another type than text hold tool traffic and are left out.
    """
    kept = F.filter(listed(value), lambda b: is_text(b) | (is_object(b) & F.coalesce(
        as_text(field(b, "type")), F.lit("text")).isin("text", "output_text")))
    blocks = F.transform(kept, lambda b: F.coalesce(as_text(b), _object_prose(b)))
    joined = F.array_join(F.filter(blocks, lambda t: t.rlike(r"(?U)\S")), "\n")
    return F.coalesce(as_text(value), F.when(is_object(value), _object_prose(value)), joined)
