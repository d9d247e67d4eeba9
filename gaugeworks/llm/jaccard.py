"""Similarity join on word shingles: every pair of documents with Jaccard of 0.75 or more.

Copies of a set are folded first. Sets meet at shingles of their prefixes, the first
quarter in an order that puts common shingles last. Each set is tried against a likely
centre and a few others first; every pair of sets still in different components is
tried after that: where few sets share a shingle one by one, where many do tile against
tile, tiles holding sets of one size band. Hashed bitmaps bound the overlap from above,
and what is left is decided by intersecting sorted arrays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType

from gaugeworks.llm.components import components
from gaugeworks.llm.store import begun, fresh, given_back, written
from gaugeworks.llm.words import Words, mixed, row_words

WORDS = 5
#: Documents link where 100 * intersection >= THRESHOLD * union.
THRESHOLD = 75
#: Bits of a bitmap: a power of two, at least twice the set's size within these bounds.
LEAST_BITS, MOST_BITS = 512, 1 << 17
#: One set in so many is looked at to learn which shingles are common; those met
#: COMMON times there come last in the order of prefixes. Any order gives the same links.
LOOKED_AT, COMMON = 16, 6
ORDER_BITS = 1 << 24
#: Bytes of text whose shingles are made at once; a shingle takes some hundred bytes on the way.
CHUNK = 1 << 18
FILTER_BITS = 1 << 23
#: Others a set is tried against in the second round.
DRAWN = 8
#: Sets of a shingle that are paired one by one in the last round; those of commoner shingles are compared in tiles.
FEW = 40
#: Sets and shingles a tile is meant to hold, and bits of a tile's bitmaps for each shingle at least.
TILE_SETS, TILE_SHINGLES, TILE_BITS = 1024, 1 << 18, 8

_A, _B = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


def shingles(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of each shingle; a row of one to four words has them all as one."""
    h, bounds = words.hashes, words.bounds
    sizes = np.diff(bounds)
    full = np.maximum(sizes - WORDS + 1, 0)
    row = np.repeat(np.arange(len(sizes)), full)
    start = np.arange(full.sum()) - np.repeat(np.cumsum(full) - full, full) + bounds[:-1][row]
    made = np.zeros(len(row), np.uint64)
    for k in range(WORDS):
        made = made * _A + h[start + k]
    short = np.flatnonzero((sizes > 0) & (sizes < WORDS))
    if len(short):
        few = np.zeros(len(short), np.uint64)
        for k in range(WORDS - 1):
            there = sizes[short] > k
            few = np.where(there, few * _A + h[np.minimum(bounds[short] + k, len(h) - 1)], few)
        row = np.concatenate([row, short])
        made = np.concatenate([made, few ^ (sizes[short].astype(np.uint64) * _B)])
    return row, mixed(made)


def _places(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of a shingle in the filter of common ones."""
    h = mixed(found ^ _A)
    return (h & np.uint64(ORDER_BITS - 1)).astype(np.int64), (h >> np.uint64(40)).astype(np.int64)


def _sets(column: pa.Array, common: np.ndarray | None = None):
    """(first row, rows, row of each shingle, shingle): sets in rising order within a row.

    With `common`, a filter as packed bits, shingles in it come after the others.
    """
    begun()
    for lo, hi, words in row_words(column, chunk=CHUNK):
        row, found = shingles(words)
        keys = (found, row)
        if common is not None:
            a, b = _places(found)
            keys = (found, (common[a >> 3] >> (a & 7).astype(np.uint8)) & (common[b >> 3] >> (b & 7).astype(np.uint8)) & 1, row)
        order = np.lexsort(keys)
        row, found = row[order], found[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (found[1:] != found[:-1])
        yield lo, hi - lo, row[new], found[new]
    given_back()


def _names(row: np.ndarray, found: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size, and a hash that equal sets share, and where each row's shingles begin."""
    size = np.bincount(row, minlength=n)
    ends = np.concatenate([[0], np.cumsum(size)])
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(found ^ _B))])
    name = mixed(sums[ends[1:]] - sums[ends[:-1]] + size.astype(np.uint64) * _A)
    return size, name.view(np.int64), ends


def _bitmap(found: np.ndarray, each: int = 2) -> bytes:
    bits = np.zeros(min(MOST_BITS, max(LEAST_BITS, 1 << (each * len(found)).bit_length())), np.uint8)
    bits[(found & np.uint64(len(bits) - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each document: id, size, set name and bitmap."""
    for batch in batches:
        for lo, n, row, found in _sets(batch.column(1)):
            size, name, ends = _names(row, found, n)
            packed = [_bitmap(found[x:y]) for x, y in zip(ends[:-1], ends[1:])]
            yield pa.record_batch([batch.column(0).slice(lo, n), pa.array(size), pa.array(name),
                                   pa.array(packed, pa.binary())], ["doc_id", "n", "name", "bits"])


def _filter(bits: DataFrame, size: int) -> np.ndarray:
    """The packed bits of a filter of `size` bits, from the numbers `x` of those set."""
    words = bits.groupBy(F.expr("x div 64").alias("k")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(x % 64 as int))")).alias("m")).toArrow()
    held = np.zeros(size // 64, np.int64)
    held[words["k"].to_numpy()] = words["m"].to_numpy()
    return held.view(np.uint8)


def _common_shingles(docs: DataFrame) -> np.ndarray:
    """The filter of shingles that many of the sets looked at hold."""
    def looked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for batch in batches:
            for _, n, row, found in _sets(batch.column(0)):
                _, name, _ = _names(row, found, n)
                # Copies inside a task count once.
                mine = [k for k in np.flatnonzero(name % LOOKED_AT == 0) if name[k] not in met]
                met.update(int(name[k]) for k in mine)
                keep = np.isin(row, mine)
                yield pa.record_batch([pa.array(found[keep].view(np.int64))], ["token"])

    @F.arrow_udf("array<long>")
    def places(token: pa.Array) -> pa.Array:
        pair = np.stack(_places(token.to_numpy(zero_copy_only=False).view(np.uint64)), 1)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(pair) + 1) * 2, pa.int32()), pa.array(pair.ravel()))
    often = docs.select("text").mapInArrow(looked, "token long").groupBy("token").count().filter(F.col("count") >= COMMON)
    return _filter(often.select(F.explode(places("token")).alias("x")), ORDER_BITS)


def _prefixes(common: np.ndarray):
    """Makes rows (name, n, prefix) of sets with a shingle."""
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, n, row, found in _sets(batch.column(0), common):
                size, name, ends = _names(row, found, n)
                place = np.arange(len(row)) - ends[row]
                keep = place < size[row] - (size[row] * THRESHOLD + 99) // 100 + 1
                lists = np.concatenate([[0], np.cumsum(np.bincount(row[keep], minlength=n))])
                yield pa.record_batch([
                    pa.array(name), pa.array(size),
                    pa.ListArray.from_arrays(pa.array(lists, pa.int32()), pa.array(found[keep].view(np.int64)))],
                    ["name", "n", "prefix"]).filter(pa.array(size > 0))
    return made


def _can_link(na: Column, nb: Column, overlap: Column | None = None) -> Column:
    """Whether sizes, and an upper bound of the overlap, leave a link possible."""
    sizes = 100 * F.least(na, nb) >= THRESHOLD * F.greatest(na, nb)
    return sizes if overlap is None else sizes & ((100 + THRESHOLD) * overlap >= THRESHOLD * (na + nb))


@F.arrow_udf(LongType())
def _differing(a: pa.Array, b: pa.Array) -> pa.Array:
    """Bits in which bitmaps differ, the longer one folded: at most the elements the sets differ in."""
    out = []
    for x, y in zip(a.to_pylist(), b.to_pylist()):
        x, y = (np.frombuffer(v, np.uint64) for v in sorted((x, y), key=len))
        out.append(int(np.bitwise_count(x ^ np.bitwise_or.reduce(y.reshape(-1, len(x)), axis=0)).sum()))
    return pa.array(out, pa.int64())


@F.arrow_udf(LongType())
def _common(a: pa.Array, b: pa.Array) -> pa.Array:
    """Size of the intersection of sorted arrays."""
    out = []
    for x, y in zip(a, b):
        x, y = (v.values.to_numpy(zero_copy_only=False).view(np.uint64) for v in (x, y))
        at = np.searchsorted(x, y)
        out.append(int((x[np.minimum(at, len(x) - 1)] == y).sum()))
    return pa.array(out, pa.int64())


class _Exact:
    """Decides pairs of set names by their sets."""

    def __init__(self, docs: DataFrame, classes: DataFrame):
        self.docs, self.classes = docs, classes

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that link, of `pairs` (a, b): bitmaps first, then arrays."""
        sides = [self.classes.select(F.col("name").alias(k), F.col("n").alias(f"n{k}"), F.col("bits").alias(f"bits{k}"))
                 for k in "ab"]
        known = pairs.join(sides[0], "a").join(sides[1], "b")
        bound = (F.col("na") + F.col("nb") - _differing("bitsa", "bitsb")) / 2
        near = written(known.filter(_can_link(F.col("na"), F.col("nb"), bound)).select("a", "b", "na", "nb"), "near")
        sets = self.sets_of(near.select(F.col("a").alias("name")).union(near.select("b")).distinct())
        both = (near.join(sets.select(F.col("name").alias("a"), F.col("found").alias("x")), "a")
                .join(sets.select(F.col("name").alias("b"), F.col("found").alias("y")), "b"))
        common = _common("x", "y")
        return both.filter(_can_link(F.col("na"), F.col("nb"), common)).select("a", "b")

    def sets_of(self, names: DataFrame) -> DataFrame:
        """(name, found): the sorted shingles of the named sets."""
        wanted = written(names, "wanted")
        # A filter of fixed size keeps most other sets from being moved.
        bits = _filter(wanted.select(F.col("name").bitwiseAND(F.lit(FILTER_BITS - 1)).alias("x")), FILTER_BITS)

        def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            met: set[int] = set()
            for batch in batches:
                for _, n, row, found in _sets(batch.column(0)):
                    size, name, ends = _names(row, found, n)
                    place = name & (FILTER_BITS - 1)
                    mine = []
                    for k in np.flatnonzero((size > 0) & ((bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 > 0)):
                        if name[k] not in met:  # a copy has the same set
                            met.add(int(name[k]))
                            mine.append(k)
                    if mine:
                        lists = np.concatenate([[0], np.cumsum(size[mine])])
                        values = np.concatenate([found[ends[k]:ends[k + 1]] for k in mine])
                        yield pa.record_batch([pa.array(name[mine]), pa.ListArray.from_arrays(
                            pa.array(lists, pa.int32()), pa.array(values.view(np.int64)))], ["name", "found"])
                if len(met) > 200_000:
                    met.clear()
        sets = self.docs.select("text").mapInArrow(made, "name long, found array<long>")
        return written(sets.join(wanted, "name", "left_semi").groupBy("name").agg(F.first("found").alias("found")), "sets")


@F.arrow_udf(BinaryType())
def _signature(found: pa.Array) -> pa.Array:
    """A bitmap of a set with TILE_BITS to twice as many bits for each of its shingles."""
    return pa.array([_bitmap(x.values.to_numpy(zero_copy_only=False).view(np.uint64), TILE_BITS) for x in found], pa.binary())


def _folded(maps: list[bytes]) -> np.ndarray:
    """Bitmaps as rows of 64-bit numbers, longer ones folded to the shortest."""
    rows = [np.frombuffer(x, np.uint64) for x in maps]
    width = min(map(len, rows))
    return np.stack([np.bitwise_or.reduce(x.reshape(-1, width), axis=0) for x in rows])


def _tile_pairs(one: np.ndarray, other: np.ndarray, bits: np.ndarray, np_: np.ndarray, component: np.ndarray):
    """Places (i, j) of sets, i of `one` and j of `other`, that may link and are still apart.

    Bits in which two bitmaps differ are at most the shingles the sets differ in, so bit counts
    bound the overlap from above, for a set and a whole tile at once.
    """
    size, place = np_ >> 32, np_ & 0xFFFFFFFF
    for i in one.tolist():
        small, large = np.minimum(size[i], size[other]), np.maximum(size[i], size[other])
        both = size[i] + size[other]
        before = np.minimum(place[i], place[other]) + np.minimum(size[i] - place[i], size[other] - place[other])
        near = (component[other] != component[i]) & (100 * small >= THRESHOLD * large) & (
            (100 + THRESHOLD) * before >= THRESHOLD * both)
        mine = other[near]
        if len(mine):
            overlap = (both[near] - np.bitwise_count(bits[mine] ^ bits[i]).sum(1, dtype=np.int64)) / 2
            for j in mine[(100 + THRESHOLD) * overlap >= THRESHOLD * both[near]].tolist():
                yield i, j


def _tiled(open_: DataFrame, signatures: DataFrame) -> DataFrame:
    """Pairs (a, b) that may link of the sets of each shingle of `open_` (token, name, np, component), tile against tile.

    A shingle's sets fall into bands of size, so that linking sets are in one band or in neighbours, and a
    band's into tiles of bounded size. A set goes with its bitmap, of (name, bits), to each pair of tiles it
    is in; what the bit counts leave of a pair of tiles comes out.
    """
    step = float(np.log(100 / THRESHOLD))
    banded = open_.withColumn("band", F.floor(F.log(F.shiftright("np", 32).cast("double")) / step + 1e-9).cast("int"))
    room = F.greatest(F.lit(16), F.least(F.lit(TILE_SETS), F.expr(f"{TILE_SHINGLES} div max(shiftright(np, 32))")))
    sizes = written(banded.groupBy("token", "band").agg(
        F.ceil(F.count("*") / room).cast("int").alias("tiles"), F.min("component").alias("low"),
        F.max("component").alias("high")), "bands")
    above = sizes.select("token", (F.col("band") - 1).alias("band"), F.col("tiles").alias("up"),
                         F.col("low").alias("low_up"), F.col("high").alias("high_up"))
    below = sizes.select("token", (F.col("band") + 1).alias("band"), F.col("tiles").alias("down"),
                         F.col("low").alias("low_down"), F.col("high").alias("high_down"))
    around = sizes.join(above, ["token", "band"], "left").join(below, ["token", "band"], "left")

    def apart(side: str) -> Column:
        return (F.least("low", f"low_{side}") != F.greatest("high", f"high_{side}")) & F.col(side).isNotNull()

    tile = F.pmod(F.xxhash64("name"), F.col("tiles")).cast("int")

    def against(n: str, low_band: str, i: str, j: str) -> Column:
        """The keys of the pairs of tiles a set is in, with all tiles of a band."""
        return F.expr(f"transform(sequence(0, {n} - 1), t -> named_struct('band', {low_band}, 'i', {i}, 'j', {j}))")
    none = F.expr("cast(array() as array<struct<band:int,i:int,j:int>>)")
    # j counts the tiles of the next band from 1,000,000 on.
    keys = F.concat(F.when(F.col("low") != F.col("high"), against("tiles", "band", "least(t, tile)", "greatest(t, tile)")).otherwise(none),
                    F.when(apart("up"), against("up", "band", "tile", "1000000 + t")).otherwise(none),
                    F.when(apart("down"), against("down", "band - 1", "t", "1000000 + tile")).otherwise(none))
    dealt = (banded.join(around, ["token", "band"]).withColumn("tile", tile)
             .select("token", "name", "np", "component", "band", "tile", F.explode(keys).alias("k"))
             .select("token", F.col("k.band").alias("low"), "k.i", "k.j", "name", "np", "component",
                     (F.col("band") > F.col("k.band")).cast("int").alias("upper"), "tile").join(signatures, "name"))

    def compared(table: pa.Table) -> pa.Table:
        i, j = table["i"][0].as_py(), table["j"][0].as_py()
        names, np_, component = (table[c].to_numpy() for c in ("name", "np", "component"))
        tile, upper = table["tile"].to_numpy(), table["upper"].to_numpy()
        bits = _folded(table["bits"].to_pylist())
        if i == j:  # a tile with itself, each pair once
            every, pairs = np.arange(len(names)), []
            for half in range(0, len(names), 64):
                pairs += _tile_pairs(every[half:half + 64], every[half:], bits, np_, component)
        else:
            first = (upper == 0) & (tile == i)
            pairs = list(_tile_pairs(np.flatnonzero(first), np.flatnonzero(~first), bits, np_, component))
        ends = np.array(pairs, np.int64).reshape(-1, 2)
        ends = np.sort(names[ends], axis=1)
        return pa.table({"a": ends[:, 0], "b": ends[:, 1]})
    return dealt.groupBy("token", "low", "i", "j").applyInArrow(compared, "a long, b long")


def join(df: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, classes, links) of the similarity join of `df` (doc_id, text).

    documents: doc_id, n, name (the set's name, shared by equal sets) of each row;
    classes: name, n, first (least doc_id), component, and component_id, the least
    doc_id the links of the component reach; links: pairs (a, b) of names, enough of
    them to hold every component together.
    """
    docs = df.select("doc_id", "text")
    kind = dict(docs.dtypes)["doc_id"]
    rows = written(docs.mapInArrow(_described, f"doc_id {kind}, n long, name long, bits binary"), "described")
    common = _common_shingles(docs)
    classes = written(rows.filter("n > 0").groupBy("name").agg(
        F.first("n").alias("n"), F.min("doc_id").alias("first"), F.first("bits").alias("bits")), "classes")

    folded = docs.select("text").mapInArrow(_prefixes(common), "name long, n long, prefix array<long>").groupBy(
        "name").agg(F.first("n").alias("n"), F.first("prefix").alias("prefix"))
    at = folded.select("name", F.posexplode("prefix").alias("place", "token"), "n").select(
        "token", "name", F.expr("shiftleft(n, 32) | place").alias("np"))
    group = Window.partitionBy("token")
    shared = written(at.withColumn("many", F.count("*").over(group)).filter("many > 1"), "shared")
    # The pivot of a shingle is the set whose shingles are most widely shared: of
    # copies of one text rather the text than a copy.
    weight = shared.groupBy("name").agg((F.sum("many") / F.first(F.shiftright("np", 32))).alias("weight"))
    shared = written(shared.join(weight, "name").select("token", "name", "np", F.max(F.struct(
        "weight", "name", "np")).over(group).alias("pivot")), "pivoted")

    def possible(a: str, b: str) -> Column:
        (na, ia), (nb, ib) = ((F.shiftright(x, 32), F.expr(f"{x} & 4294967295L")) for x in (a, b))
        return _can_link(na, nb, F.least(ia, ib) + F.least(na - ia, nb - ib))

    exact = _Exact(docs, classes)
    # Of the pivots a set meets, the one met most often is tried first.
    met = (shared.withColumn("pnp", F.col("pivot.np")).filter("name <> pivot.name").filter(possible("np", "pnp"))
           .groupBy(F.col("pivot.name").alias("a"), F.col("name").alias("b")).count())
    tried = written(met.groupBy("b").agg(F.max(F.struct("count", "a")).alias("x")).select("x.a", "b"), "tried")
    links = written(exact.links(tried), "links")

    def placed(links: DataFrame) -> DataFrame:
        """The shared shingles with the component each set is in so far."""
        part = components(links).select(F.col("node").alias("name"), "component")
        return shared.drop("pivot").join(part, "name", "left").withColumn("component", F.coalesce("component", "name"))

    # Then each set is tried against a few others drawn by its shingles, which joins
    # what is left of large groups without a pair for every two of their sets.
    drawn = placed(links).withColumn("pivot", F.min(F.struct(
        F.xxhash64("name", "token").alias("h"), "name", "np", "component")).over(group)).filter(
        "component <> pivot.component").withColumn("pnp", F.col("pivot.np")).filter(possible("np", "pnp"))
    some = drawn.select(F.col("pivot.name").alias("a"), F.col("name").alias("b")).distinct().join(
        tried, ["a", "b"], "left_anti").withColumn(
        "rank", F.row_number().over(Window.partitionBy("b").orderBy(F.xxhash64("a", "b"), "a"))).filter(
        F.col("rank") <= DRAWN).select("a", "b")
    some = written(some, "drawn")
    links = written(links.union(exact.links(some)), "links")

    now = placed(links)
    split = now.groupBy("token").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter(
        "x <> y").select("token")
    open_ = written(now.join(split, "token", "left_semi"), "open")
    counts = open_.groupBy("token").agg(F.count("*").alias("n"))
    few = open_.join(counts.filter(F.col("n") <= FEW).select("token"), "token")
    one = few.select("token", F.col("name").alias("a"), F.col("np").alias("npa"), F.col("component").alias("ca"))
    two = few.select("token", F.col("name").alias("b"), F.col("np").alias("npb"), F.col("component").alias("cb"))
    before = tried.union(some).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = (one.join(two, "token").filter("a < b AND ca <> cb").filter(possible("npa", "npb"))
             .select("a", "b").distinct().join(before, ["a", "b"], "left_anti"))
    crowd = written(open_.join(counts.filter(F.col("n") > FEW).select("token"), "token"), "crowd")
    if not crowd.isEmpty():
        sharp = exact.sets_of(crowd.select("name").distinct()).select("name", _signature("found").alias("bits"))
        tiled = _tiled(crowd, written(sharp, "signatures")).distinct().join(before, ["a", "b"], "left_anti")
        pairs = pairs.union(tiled).distinct()
    links = written(links.union(exact.links(written(pairs, "pairs"))), "links")

    final = components(links)
    named = classes.join(final.select(F.col("node").alias("name"), "component"), "name", "left").withColumn(
        "component", F.coalesce("component", "name"))
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    return rows, written(named.join(least, "component").drop("bits"), "named"), links


def linked(df: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of each row of `df` (doc_id, text).

    Null and empty texts have no shingles and are their own component. Rows with the
    same words are linked, those with one id too. A null id counts as a document but
    never names a component of others. An empty table gives an empty result.
    """
    rows, classes, _ = join(df)
    of = rows.select("doc_id", "n", "name").join(classes.select("name", "component_id"), "name", "left")
    return of.select("doc_id", F.col("n").alias("n_shingles"),
                     F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def deduplicated(df: DataFrame) -> DataFrame:
    """`df` with one row of each component, the first as the table lies; rows without shingles stay.

    `df` must be read alike each time, as files are. Ids may be null or repeated.
    """
    row, = fresh(df, "row_of_join")
    placed = df.withColumn(row, F.monotonically_increasing_id())
    marks = linked(placed.select(F.col(row).alias("doc_id"), "text"))
    stay = written(marks.filter("doc_id = component_id").select(F.col("doc_id").alias(row)), "stay")
    return placed.join(stay, row, "left_semi").select(*(F.col(f"`{c}`") for c in df.columns))
