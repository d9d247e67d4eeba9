"""Text expressions of the comparison engine, whose patterns have no look-around."""

from __future__ import annotations

import unicodedata

W = r"[\p{{L}}\p{{N}}_]"
NOT_W = r"[^\p{{L}}\p{{N}}_]"
NUMBER = r"(?:\B-|\b)(?:\d{{1,3}}(?:,\d{{3}})+|\d+)(?:\.\d+)?(?:[eE][-+]?\d+)?\b"


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def canon(x: str) -> str:
    v = f"try_cast(replace({x}, ',', '') AS DOUBLE)"
    small = f"rtrim(CAST(CAST(round({v}, 6) AS DECIMAL(38,6)) AS VARCHAR), '0')"
    return (f"CASE WHEN {v} IS NULL OR isinf({v}) THEN lower(replace({x}, ',', '')) "
            f"WHEN {v} = floor({v}) AND abs({v}) < 1e15 THEN CAST(CAST({v} AS BIGINT) AS VARCHAR) "
            f"WHEN abs({v}) >= 1e15 THEN CAST({v} AS VARCHAR) "
            f"WHEN suffix({small}, '.') THEN {small} || '0' ELSE {small} END")


def numbers(x: str) -> str:
    return f"list_distinct(list_transform(regexp_extract_all({x}, '{NUMBER}'), lambda n: {canon('n')}))"


def interesting(x: str) -> str:
    return f"abs(try_cast({x} AS DOUBLE)) >= 10"


PATH = r"[\p{{L}}\p{{N}}_./-]*[\p{{L}}\p{{N}}_]+\.[A-Za-z][A-Za-z0-9]{{1,6}}\b"


def paths(x: str) -> str:
    """Assumes paths are not directly followed by a letter outside ASCII."""
    return (rf"list_distinct(list_filter(list_transform(regexp_extract_all({x}, '{PATH}'), "
            rf"lambda p: regexp_replace(p, '^[./]+|[./]+$', '', 'g')), lambda p: p <> ''))")


def base_name(x: str) -> str:
    return rf"regexp_extract({x}, '[^/]*$')"


def sentences(x: str) -> str:
    lines = f"string_split({x}, chr(10))"
    split = (rf"string_split(regexp_replace({strip('l')}, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1))")
    return (f"list_filter(list_transform(flatten(list_transform({lines}, lambda l: {split})), "
            f"lambda s: {strip('s')}), lambda s: s <> '')")


def decomposed(x: str) -> str:
    """Letters of the Latin-1 block with their accents apart, as the compatibility fold leaves them."""
    for code in range(0xC0, 0x100):
        apart = unicodedata.normalize("NFKD", chr(code))
        if apart != chr(code):
            x = f"replace({x}, '{chr(code)}', '{apart}')"
    return x
