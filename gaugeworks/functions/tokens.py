"""Token estimates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from gaugeworks import fixed


def estimate_tokens(n_chars: Column) -> Column:
    """A quarter of the characters, at least one where there is any text."""
    return F.when(n_chars > 0, F.greatest(F.lit(1), F.floor(n_chars / fixed.CHARS_PER_TOKEN))
                  ).otherwise(F.lit(0)).cast("bigint")


def token_band(reported: Column) -> Column:
    out = F.when(reported.isNull(), F.lit(None).cast("string"))
    for edge, name in fixed.BAND_EDGES:
        out = out.when(reported < edge, F.lit(name))
    return out.otherwise(F.lit(fixed.BAND_TOP))


def _cost(width: Column, height: Column, edge: Column) -> Column:
    """Patches of an image whose long edge is scaled to `edge`."""
    scale = edge.cast("double") / F.greatest(width, height)
    w = F.greatest(F.lit(1), F.bround(width * scale, 0))
    h = F.greatest(F.lit(1), F.bround(height * scale, 0))
    patch = float(fixed.PATCH_PX)
    return (F.ceil(w / patch) * F.ceil(h / patch)).cast("bigint")


def largest_edge(width: Column, height: Column) -> Column:
    """The longest edge at which an image meets both limits.

    The cost never grows as the edge shrinks, so the interval is halved, eleven
    times for the 1,568 edges there can be.
    """
    top = F.least(F.greatest(width, height), F.lit(fixed.MAX_LONG_EDGE)).cast("bigint")

    def halve(s: Column, _: Column) -> Column:
        mid = F.floor((s["lo"] + s["hi"] + 1) / 2)
        fits = _cost(width, height, mid) <= fixed.MAX_VISUAL_TOKENS
        return F.struct(F.when(fits, mid).otherwise(s["lo"]).alias("lo"),
                        F.when(fits, s["hi"]).otherwise(F.greatest(s["lo"], mid - 1)).alias("hi"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(11)),
                       F.struct(F.lit(1).cast("bigint").alias("lo"), top.alias("hi")),
                       halve, lambda s: s["lo"])


def visual_tokens(width: Column, height: Column) -> Column:
    """Patches an image costs at the largest size meeting both limits."""
    return F.when((width <= 0) | (height <= 0), F.lit(0).cast("bigint")).otherwise(
        _cost(width, height, largest_edge(width, height)))
