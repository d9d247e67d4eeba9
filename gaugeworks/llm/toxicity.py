"""Severity of toxic text by cumulative-link ordinal regression on sparse text features.

Features are the words of a text and their first four, five and six bytes, present
or not. One weight vector is shared by all ordered thresholds:
P(severity > k) = sigmoid(w x - t_k).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.store import begun, fresh, given_back, written
from gaugeworks.llm.words import row_words

HEADS = (4, 5, 6)
#: Bytes of text whose features are made at once.
CHUNK = 1 << 18
GRADES = 4
#: Labelled rows the model is fitted on at most, by the order of a hash of their ids.
MOST_LABELLED = 6_000
#: Features kept, those that tell the classes apart best.
MOST_FEATURES = 2_048
LEAST_SEEN = 4
#: Times the odds of toxicity, against those of all texts, that a feature must raise them to.
LEAST_LIFT = 6
#: Bands of min-hashes that near copies are found by, and min-hashes of a band.
BANDS, WIDTH = 6, 4
L2 = 0.1
STEPS = 400


@dataclass
class Severity:
    """Feature hashes in order, their weights, and the rising thresholds."""

    hashes: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray


def _found(column: pa.Array):
    """(first row, rows, row of each feature, feature hash) for successive rows."""
    begun()
    for lo, hi, words in row_words(column, heads=HEADS, chunk=CHUNK):
        row = words.rows()
        yield lo, hi - lo, np.tile(row, 1 + len(HEADS)), np.concatenate([words.hashes, *words.heads])
    given_back()


def features(text: str) -> Column:
    """The distinct feature hashes of the text; none for a null or empty one."""
    @F.arrow_udf("array<long>")
    def listed(column: pa.Array) -> pa.Array:
        parts, ends = [], [0]
        for _, n, row, found in _found(column):
            order = np.lexsort((found, row))
            row, found = row[order], found[order]
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (found[1:] != found[:-1])
            parts.append(found[new].view(np.int64))
            ends.extend((ends[-1] + np.cumsum(np.bincount(row[new], minlength=n))).tolist())
        values = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))
    return listed(F.col(text))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def above(scores: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """P(severity > k) for each score and threshold."""
    return _sigmoid(scores[:, None] - thresholds[None, :])


def fit_ordinal(rows: np.ndarray, cols: np.ndarray, n: int, width: int, grade: np.ndarray,
                l2: float = L2, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds that maximise the penalised likelihood, by Adam on all rows.

    Row i has feature j where some k has rows[k] = i and cols[k] = j. Weights stay at
    or above 0: every feature is a sign of severity. Gaps between thresholds
    are exponentials, so thresholds cannot cross.
    """
    levels = GRADES - 1
    at_most = np.array([(grade <= k).mean() for k in range(levels)]).clip(1e-3, 1 - 1e-3)
    start = np.maximum.accumulate(np.log(at_most / (1 - at_most)) + 1e-2 * np.arange(levels))
    w = np.zeros(width)
    shape = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
    state = [np.zeros(width + levels) for _ in range(2)]
    for step in range(1, steps + 1):
        t = shape[0] + np.concatenate([[0.0], np.cumsum(np.exp(shape[1:]))])
        score = np.bincount(rows, w[cols], n)
        # P(grade) = upper - lower, where upper = P(> grade - 1) and lower = P(> grade).
        cum = np.hstack([np.ones((n, 1)), above(score, t), np.zeros((n, 1))])
        upper, lower = cum[np.arange(n), grade], cum[np.arange(n), grade + 1]
        p = np.maximum(upper - lower, 1e-12)
        d_upper, d_lower = upper * (1 - upper) / p, lower * (1 - lower) / p
        g_score = d_upper - d_lower
        g_t = np.array([-(d_upper[grade == k + 1].sum()) + d_lower[grade == k].sum() for k in range(levels)])
        g_shape = np.concatenate([[g_t.sum()], [g_t[k:].sum() * np.exp(shape[k]) for k in range(1, levels)]])
        gradient = np.concatenate([np.bincount(cols, g_score[rows], width) - l2 * w, g_shape])
        for k, (keep, part) in enumerate(((0.9, gradient), (0.999, gradient**2))):
            state[k] = keep * state[k] + (1 - keep) * part
        move = 0.05 * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.999**step)) + 1e-8)
        w, shape = np.maximum(w + move[:width], 0), shape + move[width:]
    return w, shape[0] + np.concatenate([[0.0], np.cumsum(np.exp(shape[1:]))])


def graded(toxic: np.ndarray, marked: np.ndarray) -> np.ndarray:
    """0 for a clean row; a toxic row is 1, 2 or 3 by the third its number of marked features lies in."""
    grade = np.zeros(len(toxic), np.int64)
    mine = toxic > 0
    if mine.any():
        cuts = np.quantile(marked[mine], [1 / 3, 2 / 3])
        grade[mine] = 1 + (marked[mine][:, None] > cuts[None, :]).sum(1)
    return grade


def distinct(keys: np.ndarray) -> np.ndarray:
    """True for one row of each group of near copies; rows meet where they agree in a column of `keys`."""
    label = np.arange(len(keys))
    for key in [*keys.T] * 3:
        _, at = np.unique(key, return_inverse=True)
        least = np.full(at.max() + 1 if len(at) else 0, len(label))
        np.minimum.at(least, at, label)
        label = least[at]
    return label == np.arange(len(keys))


def labelled_features(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(row, toxic, found) of at most MOST_LABELLED labelled documents, row an id of its own.

    Labels without a verdict or an id are left out; of several for one id the worst
    counts, and of several documents with one id the one whose text hashes lowest.
    """
    chosen = (labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id")
              .agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(MOST_LABELLED))
    # At most MOST_LABELLED rows of two numbers.
    both = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    one = F.min(F.struct(F.xxhash64("text").alias("h"), F.col("found"), F.col("toxic"))).alias("x")
    return (both.withColumn("found", features("text")).groupBy("doc_id").agg(one)
            .select(F.col("doc_id").alias("row"), F.col("x.toxic").cast("int").alias("toxic"), "x.found"))


def _once(rows: DataFrame, held: DataFrame) -> list:
    """The rows (row, toxic) that vote, of (row, toxic, found): one of each group of near copies.

    Copies agree in all min-hashes of one of BANDS bands over their rarer features. `held` has a row for each feature.
    """
    seen = held.groupBy("feature").agg(F.count("*").alias("seen"))
    n = rows.count()
    rare = held.join(seen.filter(F.col("seen") <= max(2, n // 50)), "feature")
    least = rare.groupBy("row").agg(*(F.min(F.xxhash64("feature", F.lit(k))).alias(f"m{k}") for k in range(BANDS * WIDTH)))
    # A row without a rare feature is like no other.
    keys = [F.xxhash64(*(f"m{k}" for k in range(b * WIDTH, (b + 1) * WIDTH))) for b in range(BANDS)]
    bands = rows.select("row", "toxic").join(least, "row", "left").select("row", "toxic", *(
        F.when(F.col("m0").isNull(), F.xxhash64("row", F.lit("alone"))).otherwise(k).alias(f"k{b}") for b, k in enumerate(keys)))
    # At most MOST_LABELLED rows of a few numbers.
    got = bands.orderBy("row").toArrow()
    mine = distinct(np.stack([got[f"k{b}"].to_numpy() for b in range(BANDS)], 1))
    return [(int(r), int(t)) for r, t in zip(got["row"].to_numpy()[mine], got["toxic"].to_numpy()[mine])]


def fit(labelled: DataFrame) -> Severity:
    """The model of rows (row, toxic, found); of near copies one row counts.

    Features are counted in Spark, by rows with them and by toxic ones. The driver holds the kept features and
    which of the at most MOST_LABELLED rows have them, no feature lists.
    Without rows of both classes every score is 0 and the thresholds say "clean".
    """
    spark = labelled.sparkSession
    rows = written(labelled, "labelled")
    held = rows.select("row", F.explode("found").alias("feature"))
    voters = _once(rows, held)
    n, n_pos = len(voters), sum(t > 0 for _, t in voters)
    if not 0 < n_pos < n:
        return Severity(np.zeros(0, np.uint64), np.zeros(0), np.array([5.0, 6.0, 7.0]))
    table = spark.createDataFrame(pa.table({"row": pa.array([r for r, _ in voters], pa.int64()),
                                            "toxic": pa.array([int(t > 0) for _, t in voters], pa.int32())}))
    # At most MOST_LABELLED rows of two numbers.
    voting = written(held.join(F.broadcast(table), "row"), "voting")
    seen, pos = F.col("seen"), F.col("pos")
    counts = voting.groupBy("feature").agg(F.count("*").alias("seen"), F.sum("toxic").alias("pos"))
    expected = seen * n_pos / n
    # A word that speaks for a clean text could hide one that does not, so only signs of toxicity count.
    signs = counts.filter((seen >= LEAST_SEEN) & (pos * (n - n_pos) > LEAST_LIFT * (seen - pos) * n_pos))
    gain = (pos - expected) * (pos - expected) / (expected * (1 - seen / n) + 1e-9)
    best = written(signs.orderBy(gain.desc(), "feature").limit(MOST_FEATURES), "features")
    kept = best.toArrow()
    if not len(kept):
        return Severity(np.zeros(0, np.uint64), np.zeros(0), np.array([5.0, 6.0, 7.0]))
    names = kept["feature"].to_numpy().view(np.uint64)
    order = np.argsort(names)
    names, only = names[order], (kept["pos"].to_numpy() > 0.9 * kept["seen"].to_numpy())[order]
    # At most MOST_FEATURES features of each of MOST_LABELLED rows.
    have = voting.join(F.broadcast(best.select("feature")), "feature").select("row", "feature").toArrow()
    ids = np.array(sorted(r for r, _ in voters))
    toxic = np.array([t > 0 for _, t in sorted(voters)]).astype(np.int64)
    at = np.searchsorted(ids, have["row"].to_numpy())
    cols = np.searchsorted(names, have["feature"].to_numpy().view(np.uint64))
    grade = graded(toxic, np.bincount(at, only[cols].astype(float), n))
    w, t = fit_ordinal(at, cols, n, len(names), grade)
    return Severity(names, w, t)


def scored(df: DataFrame, model: Severity) -> DataFrame:
    """`df` with severity (expected, 0 to 3), p_toxic, grade (likeliest) and toxic.

    A text counts as toxic where a severity above 0 is likelier than not. A null or
    empty text has no feature and gets the score of the thresholds alone. A column
    already called like a result stays; the result gets an underscore before it.
    """
    put = fresh(df, "severity", "p_toxic", "grade", "toxic", "of_toxicity")
    hashes, weights, thresholds = model.hashes, model.weights, model.thresholds

    @F.arrow_udf("struct<severity:double,p_toxic:double,grade:int>")
    def score(column: pa.Array) -> pa.Array:
        near = np.zeros(1 << 20, bool)
        near[hashes >> np.uint64(44)] = True
        total = np.zeros(len(column))
        for lo, n, row, found in _found(column):
            maybe = near[found >> np.uint64(44)]
            row, found = row[maybe], found[maybe]
            if len(hashes) and len(found):
                at = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
                hit = hashes[at] == found
                pair = np.unique(row[hit] * len(hashes) + at[hit])
                total[lo:lo + n] += np.bincount(pair // len(hashes), weights[pair % len(hashes)], n)
        over = above(total, thresholds)
        each = -np.diff(np.hstack([np.ones((len(total), 1)), over, np.zeros((len(total), 1))]), axis=1)
        return pa.StructArray.from_arrays(
            [pa.array(over.sum(1)), pa.array(over[:, 0]), pa.array(each.argmax(1).astype(np.int32))],
            ["severity", "p_toxic", "grade"])

    held = df.withColumn(put[4], score(F.col("text")))
    got = [F.col(f"{put[4]}.{c}") for c in ("severity", "p_toxic", "grade")]
    return held.select(*(F.col(f"`{c}`") for c in df.columns), *(g.alias(p) for g, p in zip(got, put)),
                       (got[1] >= 0.5).alias(put[3]))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`docs` (doc_id, text and others) scored by a model fitted on their labelled rows."""
    return scored(docs, fit(labelled_features(docs, labels)))
