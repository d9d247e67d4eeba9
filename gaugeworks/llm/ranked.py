"""Ranked lexical search: exact top documents of each query by sparse ball trees.

One pass over the texts counts the query terms of every document. The counts become
impact vectors over those terms, and each task keeps its documents, block by block, in
a ball tree. The inner product of a query with any document of a ball is at most that
with the ball's centre plus, for each group of terms, the length of the query there
times the ball's radius there. Balls are opened best first until no bound reaches the
score of the last place; documents of opened leaves are scored in whole numbers.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.llm.store import written
from gaugeworks.llm.words import mixed, powers

TOP = 20
#: Queries searched in one pass over the documents.
PASS = 512
#: Cells of one block's matrix of documents and terms, and documents of a leaf.
CELLS, LEAF = 1 << 21, 16
#: Groups of terms a ball has a radius for.
GROUPS = 256
#: Bytes of text whose terms are found at once; a cut never falls inside a term.
CHUNK = 1 << 20
#: Relative room left for rounding in a bound, far above what sums of positive doubles lose.
ROOM = 1e-9

#: Bytes of terms: letters and digits of ASCII, and all of what is not ASCII.
_INSIDE = np.zeros(256, bool)
_INSIDE[48:58] = _INSIDE[65:91] = _INSIDE[97:123] = _INSIDE[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] = np.arange(97, 123)


def found(data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(hash, start, end) of the terms of UTF-8 bytes, chunk by chunk; capitals of ASCII count as small."""
    at = 0
    while at < len(data):
        end = min(at + CHUNK, len(data))
        while end < len(data) and _INSIDE[data[end]]:
            end += 1
        part = data[at:end]
        edge = np.diff(_INSIDE[part].astype(np.int8), prepend=0, append=0)
        starts, ends = np.flatnonzero(edge > 0), np.flatnonzero(edge < 0)
        up, down = powers(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((_LOWER[part].astype(np.uint64) + np.uint64(1)) * up[:len(part)], out=sums[1:])
        yield mixed((sums[ends] - sums[starts]) * down[starts]), starts + at, ends + at
        at = end


def terms(text: str | None) -> list[bytes]:
    """The terms of one text in order, repeats included; none for null."""
    data = np.frombuffer((text or "").encode(), np.uint8)
    low = _LOWER[data].tobytes()
    return [low[s:e] for _, starts, ends in found(data) for s, e in zip(starts.tolist(), ends.tolist())]


class Vocabulary:
    """Terms by hash. What has a term's hash is compared with it byte by byte."""

    def __init__(self, words: list[bytes]):
        at = [next(iter(found(np.frombuffer(w, np.uint8))))[0][0] for w in words]
        order = np.argsort(np.array(at, np.uint64), kind="stable")
        self.hashes = np.array(at, np.uint64)[order]
        self.words = [words[i] for i in order]
        self.number = {w: i for i, w in enumerate(self.words)}
        self.lengths = np.array([len(w) for w in self.words])
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]
        self.bytes = np.frombuffer(b"".join(self.words), np.uint8)
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[self.hashes >> np.uint64(48)] = True

    def numbers(self, data: np.ndarray, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """(place in the arguments, number of the term) of those that are in the vocabulary."""
        near = np.flatnonzero(self.maybe[hashes >> np.uint64(48)])
        if not len(self.words) or not len(near):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        term = np.searchsorted(self.hashes, hashes[near])
        term = np.minimum(term, len(self.hashes) - 1)
        good = (self.hashes[term] == hashes[near]) & (self.lengths[term] == (ends - starts)[near])
        near, term = near[good], term[good]
        length = self.lengths[term]
        step = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        same = _LOWER[data[np.repeat(starts[near], length) + step]] == self.bytes[np.repeat(self.starts[term], length) + step]
        right = np.logical_and.reduceat(same, np.cumsum(length) - length) if len(length) else np.zeros(0, bool)
        return near[right], term[right]


def counted(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, n, term, tf) of each document of (doc_id, text): its terms, and how often each known one occurs."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(1).cast(pa.large_string()).fill_null("")
            _, where, held = text.buffers()
            size = len(text)
            if not size:
                continue
            offsets = np.frombuffer(where, np.int64)[text.offset:text.offset + size + 1]
            every = np.frombuffer(held, np.uint8) if held is not None and held.size else np.zeros(0, np.uint8)
            n, keys = np.zeros(size, np.int64), []
            lo = 0
            while lo < size:  # rows of about a chunk, or one longer row
                hi = min(size, max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + CHUNK, "right")) - 1))
                data = every[offsets[lo]:offsets[hi]]
                if hi - lo > 1:  # a blank between rows keeps their terms apart
                    cuts = offsets[lo + 1:hi] - offsets[lo]
                    data = np.insert(data, cuts, 32)
                    first = np.concatenate([[0], cuts + np.arange(1, hi - lo)])
                else:
                    first = np.zeros(1, np.int64)
                for hashes, starts, ends in found(data):
                    row = lo + np.searchsorted(first, starts, "right") - 1
                    n += np.bincount(row, minlength=size)
                    at, term = vocabulary.numbers(data, hashes, starts, ends)
                    keys.append(row[at] * max(1, len(vocabulary.words)) + term)
                lo = hi
            key, tf = np.unique(np.concatenate(keys), return_counts=True) if keys else (np.zeros(0, np.int64),) * 2
            row, term = np.divmod(key.astype(np.int64), max(1, len(vocabulary.words)))
            ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=size))]).astype(np.int32))
            yield pa.record_batch([batch.column(0), pa.array(n),
                                   pa.ListArray.from_arrays(ends, pa.array(term.astype(np.int32))),
                                   pa.ListArray.from_arrays(ends, pa.array(tf.astype(np.int32)))], ["doc_id", "n", "term", "tf"])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(count, "doc_id long, n long, term array<int>, tf array<int>")


@dataclass
class Balls:
    """A tree over the rows of a matrix; node i has rows order[lo[i]:hi[i]] and children left[i], left[i] + 1, or none (-1)."""

    order: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    left: np.ndarray
    centre: np.ndarray
    radius: np.ndarray


def grown(x: np.ndarray, group: np.ndarray) -> Balls:
    """The ball tree of the rows of `x`; `group` is the group of each column, in order.

    A ball is cut between two of its rows that lie far apart, at the middle of how much nearer rows are
    to one than to the other, so depth is logarithmic and equal rows do not matter.
    """
    order, spans, left, centres, radii = np.arange(len(x)), [(0, len(x))], [], [], []
    cuts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    at = 0
    while at < len(spans):
        lo, hi = spans[at]
        mine = x[order[lo:hi]]
        centre = mine.mean(0)
        square = np.add.reduceat((mine - centre) ** 2, cuts, axis=1)
        centres.append(centre)
        radii.append(np.sqrt(square.max(0)))
        left.append(-1)
        if hi - lo > LEAF:
            a = mine[square.sum(1).argmax()]
            b = mine[((mine - a) ** 2).sum(1).argmax()]
            middle = (lo + hi) // 2
            order[lo:hi] = order[lo:hi][np.argpartition(mine @ (a - b), middle - lo)]
            left[at] = len(spans)
            spans += [(lo, middle), (middle, hi)]
        at += 1
    lo, hi = np.array(spans).T
    return Balls(order, lo, hi, np.array(left), np.array(centres), np.array(radii))


def _key(doc: int | None) -> tuple:
    return (doc is None, doc or 0)


class Best:
    """The best `k` (score, id) of one query; of equal scores the smaller id, null last."""

    def __init__(self, k: int):
        self.k, self.heap = k, []

    def floor(self) -> int:
        """The score below which nothing enters."""
        return self.heap[0][0] if len(self.heap) == self.k else 1

    def add(self, score: int, doc: int | None) -> None:
        none, number = _key(doc)
        entry = (score, -int(none), -number)
        if len(self.heap) < self.k:
            heapq.heappush(self.heap, entry)
        elif entry > self.heap[0]:
            heapq.heapreplace(self.heap, entry)

    def rows(self) -> Iterator[tuple[int, int | None]]:
        for score, none, number in self.heap:
            yield score, None if none else -number


@dataclass
class Queries:
    """Queries over columns of terms: for each its columns and its whole-number weights there."""

    columns: list[np.ndarray]
    weights: list[np.ndarray]
    repeats: np.ndarray  # queries x columns
    lengths: np.ndarray  # queries x groups
    group: np.ndarray
    scale: np.ndarray

    @classmethod
    def of(cls, items: list[dict[int, int]], weight: np.ndarray) -> Queries:
        """`items` give the repeats of each term, `weight` the weight of each."""
        width = len(weight)
        # Neighbouring columns share a radius; terms of one weight have most in common.
        group = np.arange(width) * min(GROUPS, width) // max(1, width)
        cuts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if width else np.zeros(0, int)
        repeats = np.zeros((len(items), width))
        for q, item in enumerate(items):
            repeats[q, list(item)] = list(item.values())
        lengths = np.sqrt(np.add.reduceat(repeats**2, cuts, axis=1)) if width else np.zeros((len(items), 0))
        columns = [np.array(sorted(i), np.int64) for i in items]
        return cls(columns, [weight[c] * np.array([i[t] for t in c], np.int64) for c, i in zip(columns, items)],
                   repeats, lengths, group, weight.astype(float))


def searched(impact: np.ndarray, ids: list, queries: Queries, best: list[Best]) -> int:
    """Brings the documents of a block, rows of `impact`, into `best`; the number of documents scored."""
    tree = grown(impact * queries.scale, queries.group)
    bounds = (queries.repeats @ tree.centre.T + queries.lengths @ tree.radius.T) * (1 + ROOM)
    scored = 0
    for q, top in enumerate(best):
        if not len(queries.columns[q]):
            continue
        open_, bound = [(-bounds[q, 0], 0)], bounds[q]
        while open_ and -open_[0][0] >= top.floor():
            node = heapq.heappop(open_)[1]
            if tree.left[node] >= 0:
                for child in (tree.left[node], tree.left[node] + 1):
                    heapq.heappush(open_, (-bound[child], child))
                continue
            rows = tree.order[tree.lo[node]:tree.hi[node]]
            scores = impact[rows[:, None], queries.columns[q]] @ queries.weights[q]
            scored += len(rows)
            for i in np.flatnonzero(scores >= top.floor()):
                top.add(int(scores[i]), ids[rows[i]])
    return scored


def _leading(rows: DataFrame, *by: str, k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "copy")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _of_pass(docs: DataFrame, items: list[tuple[int, list[bytes]]], k: int) -> DataFrame:
    """(q, doc_id, score, rank) for the items of one pass, (q, terms)."""
    vocabulary = Vocabulary(sorted({w for _, words in items for w in words}))
    rows = written(counted(docs, vocabulary), "terms")
    total = rows.agg(F.count_if(F.col("n") > 0).alias("n"), F.sum("n").alias("l")).first()
    n_docs, length = total.n or 0, total.l or 1
    # One row for each term of the pass.
    weights = rows.select(F.explode("term").alias("term")).groupBy("term").agg(F.count("*").alias("df")).select(
        "term", F.floor(F.lit(1000) * F.log((F.lit(2.0) * n_docs + 2) / (F.lit(2.0) * F.col("df") + 1))).cast("long").alias("w"))
    got = weights.toArrow()
    # A term no document holds scores nothing; columns in order of weight.
    order = np.lexsort((got["term"].to_numpy(), -got["w"].to_numpy()))
    column = np.full(max(1, len(vocabulary.words)), -1)
    column[got["term"].to_numpy()[order]] = np.arange(len(order))
    weight = got["w"].to_numpy()[order].astype(np.int64)
    asked = []
    for _, words in items:
        item: dict[int, int] = {}
        for w in words:
            if (c := int(column[vocabulary.number[w]])) >= 0:
                item[c] = item.get(c, 0) + 1
        asked.append(item)
    names, width = [q for q, _ in items], max(1, len(weight))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = Queries.of(asked, weight)
        best = [Best(k) for _ in asked]
        for batch in batches:
            batch = batch.filter(pc.greater(pc.list_value_length(batch.column(2)), 0))
            for lo in range(0, len(batch), max(1, CELLS // width)):
                part = batch.slice(lo, max(1, CELLS // width))
                ends = part.column(2).offsets.to_numpy()
                row = np.repeat(np.arange(len(part)), np.diff(ends))
                term, tf = (part.column(c).values.to_numpy()[ends[0]:ends[-1]].astype(np.int64) for c in (2, 3))
                m = 75 + 25 * part.column(1).to_numpy() * n_docs // length
                impact = np.zeros((len(part), len(weight)), np.int64)
                impact[row, column[term]] = 1_000_000_000 * tf // (1000 * tf + 12 * m[row])
                searched(impact, part.column(0).to_pylist(), queries, best)
        out = [(names[q], doc, score, i) for q, top in enumerate(best) for i, (score, doc) in enumerate(top.rows())]
        yield pa.record_batch([pa.array(list(c), t) for c, t in zip(
            zip(*out) if out else [()] * 4, (pa.int64(), pa.int64(), pa.int64(), pa.int32()))], ["q", "doc_id", "score", "copy"])

    if not len(weight):
        return rows.sparkSession.createDataFrame([], "q long, doc_id long, score long, rank int")
    tops = rows.mapInArrow(search, "q long, doc_id long, score long, copy int").withColumn("part", F.spark_partition_id() % 64)
    return _leading(_leading(tops, "q", "part", k=k).drop("rank"), "q", k=k).select("q", "doc_id", "score", "rank")


def search(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """item_id, rank, doc_id and score of the `k` documents of (doc_id, text) that suit each item of (item_id, text) best.

    Every row of `items` is an item, repeated ids included; PASS of them are searched in a pass over the
    documents. Null and empty texts hold no term: such documents count nowhere, such items have no result.
    Ties go to the smaller doc_id, null last; equal rows of documents each have a place. Empty tables
    give an empty result. Other columns are left out.
    """
    spark, done, block = docs.sparkSession, [], []
    names = written(items.select("item_id", "text").orderBy("item_id", "text").select(
        F.monotonically_increasing_id().alias("q"), "item_id", "text"), "items")

    def found_by(part):
        done.append(written(_of_pass(docs, [(r.q, terms(r.text)) for r in part], k), "ranked"))
    # A pass has its items on the driver, not more.
    for row in names.orderBy("q").toLocalIterator():
        block.append(row)
        if len(block) == PASS:
            found_by(block)
            block = []
    if block or not done:
        found_by(block)
    every = done[0]
    for one in done[1:]:
        every = every.union(one)
    return every.join(names.select("q", "item_id"), "q").select("item_id", "rank", "doc_id", "score")


ORACLE = r"""
WITH t AS (SELECT doc_id, row_number() OVER () AS r, unnest(regexp_extract_all(
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
q AS (SELECT item_id, row_number() OVER () AS i, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
qt AS (SELECT item_id, i, term, count(*) AS times FROM q GROUP BY ALL),
d AS (SELECT doc_id, r, count(*) AS n FROM t GROUP BY ALL),
a AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS len FROM d),
tf AS (SELECT r, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM qt) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2.0::DOUBLE * df + 1))) AS BIGINT) AS w
      FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), a),
x AS (SELECT r, term, w * (1000000000 * tf // (1000 * tf + 12 * (75 + 25 * n * docs // len))) AS part
      FROM tf JOIN d USING (r) JOIN w USING (term), a),
s AS (SELECT item_id, i, doc_id, r, CAST(sum(times * part) AS BIGINT) AS score
      FROM qt JOIN x USING (term) JOIN d USING (r) GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST, r) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM k WHERE rank <= 20
"""
