"""Line dedup by a segment-partition edit join.

A line falls into ERRORS + 1 segments. A line within ERRORS edits has one of them
unchanged, so each line probes, for every length it may match, an index of segments
with the substrings that could be one. What meets is decided by a banded bit-parallel
edit distance. Lines within reach of each other, directly or through others, are one
class; of a class the first line as the table lies stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from gaugeworks.llm.components import components
from gaugeworks.llm.store import begun, fresh, given_back, written
from gaugeworks.llm.words import mixed, powers

ERRORS = 2
#: Shorter lines have no near matches: two edits would make other lines of them.
LEAST_CHARS = 24
#: With this as `least`, exact copies of any line with a word are repeats.
ANY = 1
BATCH_CHARS = 1 << 18
FILTER_BITS = 1 << 23

_SALT = np.uint64(0x9FB21C651E98DF25)


def _lines(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, str]]:
    """(first row, rows, row, position, start, size, joined text) of the lines of successive rows."""
    begun()
    # Only the texts of one stretch are Python strings at one time; a text has no more characters than bytes.
    held = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    lo = 0
    while lo < len(held):
        hi, chars = lo, 0
        while hi < len(held) and (hi == lo or chars + held[hi] <= BATCH_CHARS):
            chars += held[hi]
            hi += 1
        batch = [x or "" for x in column.slice(lo, hi - lo).to_pylist()]
        joined = "\n".join(batch)
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        ends = np.append(np.flatnonzero(codes == 10), len(codes))
        starts = np.concatenate([[0], ends[:-1] + 1])
        per_row = np.array([x.count("\n") + 1 for x in batch])
        row = np.repeat(np.arange(hi - lo), per_row)
        position = np.arange(len(row)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
        yield lo, hi - lo, row, position, starts, ends - starts, joined
        lo = hi
    given_back()


def _sums(joined: str) -> tuple[np.ndarray, np.ndarray]:
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    up, down = powers(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up[:len(codes)], out=sums[1:])
    return sums, down


def _named(sums: np.ndarray, down: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    return mixed((sums[start + size] - sums[start]) * down[start] + size.astype(np.uint64) * _SALT)


def _with_word(joined: str, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    sums = np.concatenate([[0], np.cumsum((codes != 32) & ((codes < 9) | (codes > 13)))])
    return sums[start + size] > sums[start]


def _occurring(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """(row, position, line, size) of lines of `least` characters and more, with a word where shorter than LEAST_CHARS, from (row, text)."""
    for batch in batches:
        rows = batch.column(0).to_numpy(zero_copy_only=False)
        for lo, _, row, position, start, size, joined in _lines(batch.column(1)):
            sums, down = _sums(joined)
            long = size >= LEAST_CHARS
            if least < LEAST_CHARS:
                long |= (size >= least) & _with_word(joined, start, size)
            name = _named(sums, down, start[long], size[long])
            yield pa.record_batch([pa.array(rows[lo + row[long]]), pa.array(position[long]),
                                   pa.array(name.view(np.int64)), pa.array(size[long])],
                                  ["row", "position", "line", "size"])


def segments(size: np.ndarray, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of segment i of lines of the given sizes; the later ones take what is left over."""
    least, more = size // (ERRORS + 1), size % (ERRORS + 1)
    first = ERRORS + 1 - more
    return i * least + np.maximum(i - first, 0), least + (i >= first)


def _key(part: np.ndarray, size: np.ndarray, i: int) -> np.ndarray:
    return mixed(part ^ (size * (ERRORS + 1) + i).astype(np.uint64) * _SALT)


def _unmet(met: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of `names` are not in `met`, and `met` with them; both rise and hold nothing twice."""
    at = np.searchsorted(met, names)
    new = np.ones(len(names), bool)
    inside = at < len(met)
    new[inside] = met[at[inside]] != names[inside]
    return new, np.insert(met, at[new], names[new])


def _segmented(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, line, bag, probe) of (text): each line's own segments, and its probes for lengths up to its own."""
    met = np.zeros(0, np.uint64)
    for batch in batches:
        for *_, start, size, joined in _lines(batch.column(0)):
            sums, down = _sums(joined)
            long = np.flatnonzero(size >= LEAST_CHARS)
            name = _named(sums, down, start[long], size[long])
            _, once = np.unique(name, return_index=True)
            # Copies met lately in this task are left out; others are folded by the join.
            new, met = _unmet(met if len(met) <= 200_000 else met[:0], name[once])
            once = once[new]
            start_, size_, name = start[long[once]], size[long[once]], name[once]
            bag = _bags(joined, start_, size_)
            keys, names, bags, probes = [], [], [], []

            def emit(at: np.ndarray, where: np.ndarray, width: np.ndarray, length: np.ndarray, i: int, probe: bool):
                part = mixed((sums[where + width] - sums[where]) * down[where])
                keys.append(_key(part, length, i))
                names.append(name[at])
                bags.append(bag[at])
                probes.append(np.full(len(at), probe))
            for i in range(ERRORS + 1):
                at = np.arange(len(name))
                begin, width = segments(size_, i)
                emit(at, start_ + begin, width, size_, i, False)
                for less in range(ERRORS + 1):
                    length = size_ - less
                    begin, width = segments(length, i)
                    low = np.maximum(begin - i, begin + less - (ERRORS - i))
                    high = np.minimum(begin + i, begin + less + (ERRORS - i))
                    for shift in range(-ERRORS, 2 * ERRORS + 1):
                        where = begin + shift
                        ok = (length >= LEAST_CHARS) & (where >= np.maximum(low, 0)) & (
                            where <= np.minimum(high, size_ - width))
                        if ok.any():
                            emit(at[ok], start_[ok] + where[ok], width[ok], length[ok], i, True)
            if keys:
                yield pa.record_batch([pa.array(np.concatenate(keys).view(np.int64)),
                                       pa.array(np.concatenate(names).view(np.int64)),
                                       pa.array(np.concatenate(bags)), pa.array(np.concatenate(probes))],
                                      ["key", "line", "bag", "probe"])


def _bags(joined: str, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """How often each of 15 kinds of character occurs in a line, as the digits to base 16 of one number."""
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    kind = (codes.astype(np.uint64) * np.uint64(0x9E3779B1) >> np.uint64(7)) % np.uint64(15)
    one = np.uint64(1) << (np.uint64(4) * kind)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(one)])
    return ((sums[start + size] - sums[start]) & np.uint64((1 << 60) - 1)).view(np.int64)


def _bags_near(a: str, b: str) -> Column:
    """Whether two bags differ by no more characters than so many edits can change.

    Where they do, every digit of the difference is small, and the sum is exact;
    elsewhere it may be too small, never too large for lines within reach.
    """
    shifted = f"(({a} - {b} + {0x888888888888888}L + {1 << 60}L) & {(1 << 60) - 1}L)"
    return F.expr(" + ".join(f"abs((shiftright({shifted}, {4 * k}) & 15) - 8)" for k in range(15)) + f" <= {2 * ERRORS}")


def within(a: str, b: str, errors: int = ERRORS) -> bool:
    """Whether at most so many insertions, deletions and replacements make `b` of `a`.

    Each of the errors + 1 words has a bit for every diagonal of the band that can be
    reached with so many edits; a column is a few shifts of all diagonals at once.
    """
    if abs(len(a) - len(b)) > errors:
        return False
    x, y = (np.frombuffer(s.encode("utf-32-le"), np.uint32) for s in (a, b))
    n = min(len(x), len(y))
    differ = np.flatnonzero(x[:n] != y[:n])
    head = int(differ[0]) if len(differ) else n
    x, y = x[head:], y[head:]
    n = min(len(x), len(y))
    differ = np.flatnonzero(x[len(x) - n:] != y[len(y) - n:])
    tail = n - 1 - int(differ[-1]) if len(differ) else n
    x, y = x[:len(x) - tail], y[:len(y) - tail]
    # Bit t of a column j stands for position j + t - errors of x.
    width = 2 * errors + 1
    padded = np.full(len(y) + 2 * width, 0xFFFFFFFF, np.uint32)
    padded[errors:errors + len(x)] = x[:len(padded) - errors]
    match = sum((padded[t:t + len(y)] == y).astype(np.int64) << t for t in range(width)).tolist() if len(y) else []
    full = (1 << width) - 1
    reach = [0] * (errors + 1)
    reach[0] = 1 << errors
    for d in range(1, errors + 1):
        reach[d] = (reach[d - 1] | reach[d - 1] << 1) & full
    for m in match:
        before, reach[0] = reach[0], reach[0] & m
        for d in range(1, errors + 1):
            now = (reach[d] & m) | before | (before >> 1) | (reach[d - 1] << 1)
            before, reach[d] = reach[d], now & full
        if not reach[errors]:
            return False
    return bool(reach[errors] >> (len(x) - len(y) + errors) & 1)


@F.arrow_udf(BooleanType())
def _near(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array([within(x, y) for x, y in zip(a.to_pylist(), b.to_pylist())], pa.bool_())


def _linked(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) of line names, of `pairs`, whose lines are within reach."""
    wanted = written(pairs.select(F.col("a").alias("line")).union(pairs.select("b")).distinct(), "wanted")
    # A filter of fixed size keeps most other lines from being moved.
    words = wanted.select(F.col("line").bitwiseAND(F.lit(FILTER_BITS - 1)).alias("x")).groupBy(
        F.expr("x div 64").alias("k")).agg(F.bit_or(F.expr("shiftleft(1L, cast(x % 64 as int))")).alias("m")).toArrow()
    held = np.zeros(FILTER_BITS // 64, np.int64)
    held[words["k"].to_numpy()] = words["m"].to_numpy()
    bits = held.view(np.uint8)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for batch in batches:
            for *_, start, size, joined in _lines(batch.column(0)):
                sums, down = _sums(joined)
                long = np.flatnonzero(size >= LEAST_CHARS)
                name = _named(sums, down, start[long], size[long]).view(np.int64)
                place = name & (FILTER_BITS - 1)
                names, texts = [], []
                for k in np.flatnonzero((bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 > 0):
                    if name[k] not in met:  # a copy is the same line
                        met.add(int(name[k]))
                        names.append(int(name[k]))
                        texts.append(joined[start[long[k]]:start[long[k]] + size[long[k]]])
                yield pa.record_batch([pa.array(names, pa.int64()), pa.array(texts, pa.string())], ["line", "text"])
            if len(met) > 200_000:
                met.clear()
    texts = written(docs.select("text").mapInArrow(read, "line long, text string")
                    .join(wanted, "line", "left_semi").groupBy("line").agg(F.first("text").alias("text")), "texts")
    both = (pairs.join(texts.select(F.col("line").alias("a"), F.col("text").alias("x")), "a")
            .join(texts.select(F.col("line").alias("b"), F.col("text").alias("y")), "b"))
    return both.filter(_near("x", "y")).select("a", "b")


def classes(docs: DataFrame) -> DataFrame:
    """(node, component) of the lines of `docs` (text) that are within reach of another line."""
    rows = docs.select("text").mapInArrow(_segmented, "key long, line long, bag long, probe boolean")
    # Aggregates of numbers alone are hashed, not sorted; one row a key is a small side to hash the probes against.
    index = rows.filter("NOT probe").groupBy("key").agg(
        F.min("line").alias("low"), F.min_by("bag", "line").alias("low_bag"),
        F.max("line").alias("high"), F.max_by("bag", "line").alias("high_bag"))
    met = written(rows.filter("probe").select("key", "line", "bag").join(index.hint("shuffle_hash"), "key").filter(
        "NOT (low = high AND low = line)"), "met")
    # Against one line of each bucket first; then only what is still apart.
    low = F.col("low") == F.col("line")
    first = written(met.withColumns({"other": F.when(low, F.col("high")).otherwise(F.col("low")),
                                     "other_bag": F.when(low, F.col("high_bag")).otherwise(F.col("low_bag"))})
                    .filter(_bags_near("bag", "other_bag"))
                    .select(F.least("line", "other").alias("a"), F.greatest("line", "other").alias("b")).distinct(), "first")
    links = written(_linked(docs, first), "links")
    part = components(links).select(F.col("node").alias("line"), "component")
    full = met.filter("low <> high").select("key", "line", "bag")
    keys = written(full.select("key").distinct(), "keys")
    mine = rows.filter("NOT probe").select("key", F.col("line").alias("other"), F.col("bag").alias("other_bag")).join(keys, "key", "left_semi").distinct()

    def placed(df: DataFrame, name: str, to: str) -> DataFrame:
        return df.join(part.select(F.col("line").alias(name), F.col("component").alias(to)), name, "left").withColumn(
            to, F.coalesce(to, name))
    pairs = (placed(full, "line", "x").join(placed(mine, "other", "y"), "key").filter("x <> y").filter(_bags_near("bag", "other_bag"))
             .select(F.least("line", "other").alias("a"), F.greatest("line", "other").alias("b")).distinct()
             .join(first, ["a", "b"], "left_anti"))
    rest = written(pairs, "rest")
    return components(links if rest.isEmpty() else links.union(_linked(docs, rest)))


def removals(docs: DataFrame, least: int = LEAST_CHARS) -> DataFrame:
    """(row, positions, chars) of the lines that go, from `docs` (row, text).

    Lines under LEAST_CHARS characters go as exact copies, those under `least` never.
    """
    lines = written(docs.select("row", "text").mapInArrow(
        lambda batches: _occurring(batches, least), "row long, position long, line long, size long"), "lines")
    each = lines.groupBy("line").agg(F.min(F.struct("row", "position")).alias("at"), F.count("*").alias("n"))
    near = classes(docs).select(F.col("node").alias("line"), "component")
    held = each.join(near, "line", "left").withColumn("component", F.coalesce("component", "line"))
    whole = held.groupBy("component").agg(F.min("at").alias("stays"), F.sum("n").alias("n")).filter("n > 1")
    repeated = written(held.join(whole.select("component", "stays"), "component").select("line", "stays"), "repeated")
    gone = lines.join(repeated, "line").filter(F.struct("row", "position") != F.col("stays"))
    return gone.groupBy("row").agg(F.sort_array(F.collect_list("position")).alias("positions"),
                                   F.sum("size").alias("chars"))


def deduplicated(df: DataFrame, least: int = LEAST_CHARS) -> DataFrame:
    """`df` without the repeated lines of its texts, in its columns; a row all of whose lines went goes.

    The first line of each class, as the table lies, stays; so do lines under
    `least` characters. Null and empty texts stay as they are. Repeated rows are
    texts like any others. n_chars, where there is one, follows the text.
    """
    row, going = fresh(df, "row_of_lines", "lines_that_go")
    placed = df.withColumn(row, F.monotonically_increasing_id())
    gone = written(removals(placed.select(F.col(row).alias("row"), "text"), least), "removals").select(
        F.col("row").alias(row), F.col("positions").alias(going))

    @F.arrow_udf("string")
    def rest(text: pa.Array, positions: pa.Array) -> pa.Array:
        parts = [pa.array([], pa.string())]
        for lo in range(0, len(text), 256):  # only so many texts are Python strings at one time
            out = []
            for x, gone_ in zip(text.slice(lo, 256), positions.slice(lo, 256)):
                drop = set(gone_.as_py())
                out.append("\n".join(line for k, line in enumerate(x.as_py().split("\n")) if k not in drop))
            parts.append(pa.array(out, pa.string()))
        return pa.concat_arrays(parts)
    both = placed.join(gone, row, "left")
    some = both.filter(F.col(going).isNotNull()).withColumn("text", rest("text", going)).filter(
        F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in df.columns:
        some = some.withColumn("n_chars", F.length("text").cast(dict(df.dtypes)["n_chars"]))
    columns = [F.col(f"`{c}`") for c in df.columns]
    return both.filter(F.col(going).isNull()).select(*columns).union(some.select(*columns))


def counted(df: DataFrame, least: int = LEAST_CHARS) -> DataFrame:
    """doc_id, n_lines, n_removed and n_chars (left, with the line feeds between lines) of each row of `df`.

    A null text has no line, an empty one has one without a word; neither loses any. Repeated rows are
    texts like any others: the first in the table keeps its lines. An empty table gives an empty result,
    other columns are left out.
    """
    placed = df.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    gone = written(removals(placed.select("row", "text"), least), "removals")
    sizes = placed.select("row", "doc_id", F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long").alias("n_lines"),
                          F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n"))
    removed = F.coalesce(F.size("positions"), F.lit(0)).cast("long")
    return sizes.join(gone, "row", "left").select(
        "doc_id", "n_lines", removed.alias("n_removed"),
        F.greatest(F.col("n") - F.coalesce("chars", F.lit(0)) - removed, F.lit(0)).cast("long").alias("n_chars"))
