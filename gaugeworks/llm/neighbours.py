"""Approximate nearest neighbours: a neighbour graph by NN-descent, searched greedily.

Equal vectors are one node. The graph starts from exact neighbours inside random
blocks; in each round the forward and some reverse neighbours of every node are
compared with one another, which proposes neighbours of neighbours to both sides.
A query walks the graph: of the nearest nodes found so far those not yet visited
are expanded, until the pool holds none. Distances of the result are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType

from gaugeworks.llm.store import written

#: Neighbours of a node in the graph, and reverse neighbours compared in a round.
NEIGHBOURS = 32
REVERSE = 24
BLOCK, BLOCKINGS = 192, 2
#: Proposals one node gets from one meeting place in a round.
PROPOSALS = 10
#: Rounds end when fewer than this share of the edges is new, or after MOST_ROUNDS.
SETTLED, MOST_ROUNDS = 0.02, 12
#: Nodes of a query's pool that are expanded, those expanded at once, and entry nodes.
POOL, STEP, ENTRIES = 240, 60, 16
SEED = 7


def usable(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, v) of the rows that take part: an id, and a finite vector that is not zero.

    Vectors of another length than most have are left out as well.
    """
    v = F.col(vector).cast("array<double>")
    good = (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(
        v, lambda x: x != 0)
    rows = df.select(F.col(key).alias("id"), F.col(vector).alias("v")).filter(F.col(key).isNotNull() & good)
    size = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("v") == (size[0] if size else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    """Single-precision vectors kept as bytes."""
    if not len(column):
        return np.zeros((0, 1), np.float32)
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(len(column), -1)


def _squares(m: np.ndarray) -> np.ndarray:
    norm = (m * m).sum(1)
    d = np.maximum(norm[:, None] + norm[None, :] - 2 * (m @ m.T), 0)
    np.fill_diagonal(d, np.inf)
    return d


def _packed(vector: str, largest: float) -> Column:
    """The vector in single precision, as bytes; one scale for the table brings its largest component to 1."""
    @F.arrow_udf(BinaryType())
    def bytes_of(v: pa.Array) -> pa.Array:
        rows = (x.values.to_numpy(zero_copy_only=False).astype(np.float64) for x in v)
        return pa.array([(x / largest).astype(np.float32).tobytes() for x in rows], pa.binary())
    return bytes_of(F.col(vector))


def _blocks(nodes: DataFrame) -> DataFrame:
    """(u, v, d): each node's nearest inside the blocks that random hyperplanes cut."""
    n = nodes.count()
    bits = max(0, (n // BLOCK).bit_length() - 1)

    @F.arrow_udf("array<int>")
    def codes(packed: pa.Array) -> pa.Array:
        m = _matrix(packed)
        planes = np.random.default_rng(SEED).standard_normal((m.shape[1], BLOCKINGS * bits)).astype(np.float32)
        side = ((m @ planes) > 0).reshape(len(m), BLOCKINGS, bits) @ (1 << np.arange(bits))
        return pa.array(side.astype(np.int32).tolist(), pa.list_(pa.int32()))

    coded = written(nodes.select("node", "packed", F.posexplode(codes("packed")).alias("r", "code")), "coded")
    # A block that holds far more than its share is dealt into several.
    sizes = coded.groupBy("r", "code").agg(F.ceil(F.count("*") / (2 * BLOCK)).cast("long").alias("parts"))
    dealt = coded.join(sizes, ["r", "code"]).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")))

    def near(table: pa.Table) -> pa.Table:
        ids, m = table["node"].to_numpy(), _matrix(table["packed"].combine_chunks())
        d = _squares(m)
        k = min(NEIGHBOURS, len(ids) - 1)
        if k <= 0:
            return pa.table({"u": pa.array([], pa.int64()), "v": pa.array([], pa.int64()), "d": pa.array([], pa.float32())})
        best = np.argpartition(d, k - 1, axis=1)[:, :k]
        return pa.table({"u": np.repeat(ids, k), "v": ids[best.ravel()],
                         "d": np.take_along_axis(d, best, 1).ravel().astype(np.float32)})
    return dealt.select("r", "code", "part", "node", "packed").groupBy("r", "code", "part").applyInArrow(
        near, "u long, v long, d float")


def _nearest(edges: DataFrame, k: int) -> DataFrame:
    """The k nearest v of each u of (u, v, d, old); `fresh` where the edge was not there before."""
    each = edges.groupBy("u", "v").agg(F.min("d").alias("d"), F.max("old").alias("old"))
    rank = F.row_number().over(Window.partitionBy("u").orderBy("d", "v"))
    return each.withColumn("rank", rank).filter(F.col("rank") <= k).select(
        "u", "v", "d", (~F.col("old")).alias("fresh"))


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Proposals (u, v, d) among the members of each meeting place, where one of a pair is new."""
    for batch in batches:
        us, vs, ds = [], [], []
        for row in batch.column(0):
            members = row.values
            ids = members.field("m").to_numpy(zero_copy_only=False)
            ids, first = np.unique(ids, return_index=True)
            if len(ids) < 2:
                continue
            new = members.field("fresh").to_numpy(zero_copy_only=False)[first]
            worst = members.field("worst").to_numpy(zero_copy_only=False)[first]
            d = _squares(_matrix(members.field("packed").take(pa.array(first))))
            d[(~new)[:, None] & (~new)[None, :]] = np.inf
            k = min(PROPOSALS, len(ids) - 1)
            best = np.argpartition(d, k - 1, axis=1)[:, :k]
            far = np.take_along_axis(d, best, 1)
            row_at, col = np.nonzero(far < worst[:, None])
            us.append(ids[row_at])
            vs.append(ids[best[row_at, col]])
            ds.append(far[row_at, col])
        if us:
            yield pa.record_batch([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs)),
                                   pa.array(np.concatenate(ds).astype(np.float32))], ["u", "v", "d"])


def graph(nodes: DataFrame) -> DataFrame:
    """(u, v, d): about NEIGHBOURS nearest nodes of each node of `nodes` (node, packed)."""
    started = _blocks(nodes).withColumn("old", F.lit(False))
    edges = written(_nearest(started, NEIGHBOURS), "graph")
    for _ in range(MOST_ROUNDS):
        reverse = edges.select(F.col("v").alias("p"), F.col("u").alias("m"), "fresh").withColumn("rank", F.row_number().over(
            Window.partitionBy("p").orderBy(F.desc("fresh"), F.xxhash64("m", "p")))).filter(
            F.col("rank") <= REVERSE).drop("rank")
        members = edges.select(F.col("u").alias("p"), F.col("v").alias("m"), "fresh").union(reverse)
        worst = edges.groupBy("u").agg(F.max("d").alias("worst"), F.count("*").alias("n"))
        # A node without all its neighbours takes any proposal.
        known = nodes.join(worst, nodes["node"] == worst["u"], "left").select(
            F.col("node").alias("m"), "packed",
            F.when(F.col("n") >= NEIGHBOURS, F.col("worst")).otherwise(F.lit(float("inf"))).cast("float").alias("worst"))
        met = (members.join(known, "m").groupBy("p")
               .agg(F.collect_list(F.struct("m", "fresh", "worst", "packed")).alias("x")).select("x"))
        proposed = met.mapInArrow(_compared, "u long, v long, d float").withColumn("old", F.lit(False))
        edges = written(_nearest(edges.select("u", "v", "d", F.lit(True).alias("old")).union(proposed), NEIGHBOURS), "graph")
        count = edges.agg(F.count("*").alias("n"), F.count_if("fresh").alias("new")).first()
        if count.new <= SETTLED * count.n:
            break
    return edges.select("u", "v", "d")


@F.arrow_udf(DoubleType())
def _distance(a: pa.Array, b: pa.Array) -> pa.Array:
    x, y = (v.values.to_numpy(zero_copy_only=False)[v.offsets[0].as_py():v.offsets[-1].as_py()] for v in (a, b))
    x, y = (v.astype(np.float64).reshape(len(a), -1) for v in (x, y))
    return pa.array(np.sqrt(((x - y) ** 2).sum(1)))


def walk(queries: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(q, node, far): the POOL nearest nodes each query of (q, qv) came by, with their distances.

    A query starts at its own node where its vector is one, and at a few fixed nodes.
    """
    plain = nodes.select("node", "v")
    # ENTRIES rows.
    entries = plain.orderBy(F.xxhash64("node"), "node").limit(ENTRIES)
    own = queries.join(plain, F.col("qv") == F.col("v")).select("q", "node")
    start = queries.select("q").join(F.broadcast(entries.select("node")), F.lit(True)).union(own).distinct()

    def measured(pairs: DataFrame) -> DataFrame:
        return (pairs.join(plain, "node").join(queries, "q").withColumn("far", _distance("qv", "v"))
                .select("q", "node", "far", F.lit(False).alias("done")))
    best = Window.partitionBy("q").orderBy("far", "node")

    def ranked(pool: DataFrame) -> DataFrame:
        """The POOL nearest of each query; `now` marks the STEP nearest of these that were not expanded yet.

        Ranks only get worse: what falls out of the pool once would fall out again.
        """
        inside = pool.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= POOL)
        turn = F.row_number().over(Window.partitionBy("q", "done").orderBy("far", "node"))
        return written(inside.select("q", "node", "far", "done", (~F.col("done") & (turn <= STEP)).alias("now")), "pool")
    pool = ranked(measured(start))
    while True:
        front = pool.filter("now").select("q", "node")
        if front.isEmpty():
            return pool.select("q", "node", "far")
        met = front.join(edges.select(F.col("u").alias("node"), "v"), "node").select("q", F.col("v").alias("node")).distinct()
        new = measured(met.join(pool.select("q", "node"), ["q", "node"], "left_anti"))
        pool = ranked(pool.select("q", "node", "far", F.expr("done OR now").alias("done")).union(new))


def search(df: DataFrame, asked: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k nearest found for the rows that `asked` picks.

    Nearness is the Euclidean distance in double precision, ties to the smaller id.
    Candidates are all rows with a usable vector and another id; a query without a
    usable vector has no result. Equal vectors are indexed once and all returned in
    order of their ids. Fewer candidates than k give fewer rows, an empty table none.
    """
    rows = written(usable(df, key, vector), "vectors")
    # Of equal vectors nobody asks for more than the k + 1 smallest ids.
    place = Window.partitionBy("v").orderBy("id")
    members = rows.distinct().withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k + 1)
    named = written(members.withColumn("node", F.first("id").over(place)).select("node", "id", "v"), "members")
    kept = named.filter("node = id")
    largest = kept.select(F.max(F.array_max(F.transform("v", lambda x: F.abs(x.cast("double")))))).first()[0] or 1.0
    nodes = written(kept.select(F.xxhash64("v").alias("node"), "v", _packed("v", largest).alias("packed")), "nodes")
    edges = graph(nodes)
    queries = written(rows.filter(asked).select(F.col("id").alias("q"), F.col("v").alias("qv")), "queries")
    found = walk(queries, nodes, edges)
    near = found.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy("far", "node"))).filter(
        F.col("rank") <= k + 1).select("q", "node", "far")
    others = near.join(named.select(F.xxhash64("v").alias("node"), "id"), "node").filter("id <> q")
    order = Window.partitionBy("q").orderBy("far", "id")
    return (others.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select(F.col("q").alias("query_id"), F.col("rank").cast("int").alias("rank"),
                    F.col("id").alias("vec_id"), F.col("far").alias("score")))
