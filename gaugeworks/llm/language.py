"""Language-model scores: a log-bilinear model trained by noise-contrastive estimation.

Word counts cover all training documents. The commonest words have classes of their
own, all others share one. The model predicts the class from the two before it; a
word of the shared class then has its discounted share of that class. Every training
document is trained on where it lies, and the tasks' parameters are averaged. Scores
are normalised over all classes by batched matrix products.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.store import written
from gaugeworks.llm.words import Words, row_words

#: Words with a class of their own, size of a word's vector, words before that count.
CLASSES, SIZE, CONTEXT = 511, 16, 2
#: Examples of a step, noise words it shares, rate of learning.
BATCH, NOISE, RATE = 4096, 48, 0.08
#: Words whose counts go to every task; the counts of rarer ones are joined.
HEAD = 1 << 18
#: Rows the parameters of tasks are added up in before the driver adds those.
SUMS = 16
SEED = 11
END = np.uint64(0x5851F42D4C957F2D)


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id's text leaves 2 modulo 7; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 7 == 2


def _tokens(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(hashes with one end after each row, bounds of rows)."""
    n = len(words.bounds) - 1
    bounds = words.bounds + np.arange(n + 1)
    out = np.empty(bounds[-1], np.uint64)
    at_end = np.zeros(len(out), bool)
    at_end[bounds[1:] - 1] = True
    out[at_end], out[~at_end] = END, words.hashes
    return out, bounds


def counts(train: DataFrame) -> DataFrame:
    """(w, c): hash and number of each token of `train` (text)."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [_tokens(words)[0] for _, _, words in row_words(batch.column(0))]
            if parts:
                w, c = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.record_batch([pa.array(w.view(np.int64)), pa.array(c)], ["w", "c"])
    return train.mapInArrow(counted, "w long, c long").groupBy("w").agg(F.sum("c").alias("c"))


@dataclass
class Known:
    """What every task knows of the counts: the commonest words in hash order, and sums."""

    words: np.ndarray
    count: np.ndarray
    own: np.ndarray  # class of each word, CLASSES for the shared one
    frequency: np.ndarray  # of each class
    tokens: int
    types: int
    rest: float  # tokens of the shared class
    discount: float
    rest_types: int

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each hash among the words, or -1."""
        if not len(self.words):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, at, -1)

    def classes(self, place: np.ndarray) -> np.ndarray:
        out = np.full(len(place), CLASSES)
        out[place >= 0] = self.own[place[place >= 0]]
        return out


def known(table: DataFrame) -> Known:
    """From counts (w, c). HEAD rows come to the driver."""
    sums = table.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    top = table.orderBy(F.desc("c"), "w").limit(HEAD).toArrow()
    w, c = top["w"].to_numpy().view(np.uint64), top["c"].to_numpy().astype(np.int64)
    first = c[:CLASSES]
    rare = table.join(F.broadcast(table.orderBy(F.desc("c"), "w").limit(CLASSES).select("w")), "w", "left_anti").agg(
        F.count_if(F.col("c") == 1).alias("one"), F.count_if(F.col("c") == 2).alias("two")).first()
    own = np.minimum(np.arange(len(w)), CLASSES)
    order = np.argsort(w)
    n = int(sums.n or 0)
    rest = n - int(first.sum())
    frequency = np.zeros(CLASSES + 1)
    frequency[:len(first)], frequency[CLASSES] = first, rest
    discount = rare.one / (rare.one + 2 * rare.two) if rare.one else 0.5
    return Known(w[order], c[order], own[order], frequency, n, int(sums.v), float(rest), min(max(discount, 0.1), 0.9),
                 int(sums.v) - len(first))


@dataclass
class Model:
    """Vectors of the words before (and of a text's start), of the words to come, weights of places, biases."""

    before: np.ndarray
    after: np.ndarray
    place: np.ndarray
    bias: np.ndarray

    @staticmethod
    def start(frequency: np.ndarray) -> Model:
        rng = np.random.default_rng(SEED)
        share = (frequency + 0.5) / (frequency + 0.5).sum()
        return Model(rng.normal(0, 0.1, (CLASSES + 2, SIZE)).astype(np.float32),
                     rng.normal(0, 0.1, (CLASSES + 1, SIZE)).astype(np.float32),
                     np.ones((CONTEXT, SIZE), np.float32), np.log(share).astype(np.float32))

    def parts(self) -> list[np.ndarray]:
        return [self.before, self.after, self.place, self.bias]

    def predicted(self, context: np.ndarray) -> np.ndarray:
        return sum(self.before[context[:, j]] * self.place[j] for j in range(CONTEXT))

    def log_shares(self, context: np.ndarray) -> np.ndarray:
        """Normalised natural log-probabilities of all classes for each context."""
        score = self.predicted(context) @ self.after.T + self.bias
        score -= score.max(1, keepdims=True)
        return score - np.log(np.exp(score).sum(1, keepdims=True))


def contexts(kinds: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The CONTEXT classes before each token, CLASSES + 1 before a row's first."""
    inside = np.arange(len(kinds)) - np.repeat(bounds[:-1], np.diff(bounds))
    out = np.full((len(kinds), CONTEXT), CLASSES + 1)
    for j in range(CONTEXT):
        far = inside > j
        out[far, j] = kinds[np.flatnonzero(far) - j - 1]
    return out


class Trainer:
    """Noise-contrastive estimation by AdaGrad; the noise of a step is shared by its examples."""

    def __init__(self, frequency: np.ndarray):
        self.model = Model.start(frequency)
        share = (frequency + 0.5) / (frequency + 0.5).sum()
        self.noise_log = np.log(NOISE * share).astype(np.float32)
        self.cumulative = np.cumsum(share)
        self.squares = [np.full_like(x, 1e-2) for x in self.model.parts()]
        self.rng = np.random.default_rng(SEED)
        self.seen = 0

    def _move(self, k: int, gradient: np.ndarray) -> None:
        self.squares[k] += gradient * gradient
        self.model.parts()[k][...] += RATE * gradient / np.sqrt(self.squares[k])

    @staticmethod
    def _gathered(at: np.ndarray, gradient: np.ndarray, rows: int) -> np.ndarray:
        flat = (at[:, None] * SIZE + np.arange(SIZE)).ravel()
        return np.bincount(flat, gradient.ravel(), rows * SIZE).reshape(rows, SIZE).astype(np.float32)

    def step(self, context: np.ndarray, target: np.ndarray) -> None:
        m = self.model
        noise = np.minimum(np.searchsorted(self.cumulative, self.rng.random(NOISE)), CLASSES)
        r = m.predicted(context)
        q = m.after[target]
        true = (r * q).sum(1) + m.bias[target] - self.noise_log[target]
        false = r @ m.after[noise].T + (m.bias[noise] - self.noise_log[noise])
        up = 0.5 - 0.5 * np.tanh(0.5 * true)
        down = -0.5 - 0.5 * np.tanh(0.5 * false)
        scale = np.float32(1 / np.sqrt(len(target)))
        up, down = up * scale, down * scale
        g = up[:, None] * q + down @ m.after[noise]
        after = self._gathered(target, up[:, None] * r, CLASSES + 1)
        np.add.at(after, noise, down.T @ r)
        bias = np.bincount(target, up, CLASSES + 1)
        np.add.at(bias, noise, down.sum(0))
        before = sum(self._gathered(context[:, j], g * m.place[j], CLASSES + 2) for j in range(CONTEXT))
        place = np.stack([(g * m.before[context[:, j]]).sum(0) for j in range(CONTEXT)])
        for k, gradient in enumerate((before, after, place, bias.astype(np.float32))):
            self._move(k, gradient)
        self.seen += len(target)

    def learn(self, kinds: np.ndarray, bounds: np.ndarray) -> None:
        context = contexts(kinds, bounds)
        order = self.rng.permutation(len(kinds))
        for lo in range(0, len(order), BATCH):
            some = order[lo:lo + BATCH]
            self.step(context[some], kinds[some])


def trained(train: DataFrame, facts: Known) -> Model:
    """The model of all rows of `train` (text): each task's, averaged by the tokens it saw."""
    width = [x.size for x in Model.start(facts.frequency).parts()]

    def learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = Trainer(facts.frequency)
        for batch in batches:
            for _, _, words in row_words(batch.column(0)):
                hashes, bounds = _tokens(words)
                trainer.learn(facts.classes(facts.find(hashes)), bounds)
        if trainer.seen:
            flat = np.concatenate([x.ravel() for x in trainer.model.parts()]).astype(np.float64) * trainer.seen
            yield pa.record_batch([pa.array([trainer.seen], pa.int64()), pa.array([flat.tobytes()], pa.binary())], ["n", "x"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(sum(width))
        for batch in batches:
            for k, x in zip(batch.column(0).to_pylist(), batch.column(1)):
                n, total = n + k, total + np.frombuffer(x.as_py())
        yield pa.record_batch([pa.array([n], pa.int64()), pa.array([total.tobytes()], pa.binary())], ["n", "x"])
    tasks = written(train.mapInArrow(learned, "n long, x binary"), "trained")
    n, total = 0, np.zeros(sum(width))
    # SUMS rows of fixed size.
    for k, x in tasks.repartition(SUMS).mapInArrow(added, "n long, x binary").collect():
        n, total = n + k, total + np.frombuffer(x)
    model = Model.start(facts.frequency)
    if n:
        for held, part in zip(model.parts(), np.split((total / n).astype(np.float32), np.cumsum(width)[:-1])):
            held[...] = part.reshape(held.shape)
    return model


def _share_of_rest(count: Column, facts: Known) -> Column:
    """log10 of a rare word's share of the shared class; unseen words together have what discounts left."""
    if not facts.rest:
        return F.lit(0.0)
    unseen = max(facts.discount * facts.rest_types / facts.rest, 1e-12)
    return F.when(count > 0, F.log10((count - F.lit(facts.discount)) / F.lit(facts.rest))).otherwise(F.lit(float(np.log10(unseen))))


def scored(df: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each row of `df` (doc_id, text).

    A null or empty text is one end token. Repeated rows and ids are scored each. An
    empty table gives an empty result; without training rows nothing is known and
    the model is the uniform start.
    """
    docs = df.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), held_out().alias("held_out"))
    train = docs.filter("NOT held_out").select("text")
    table = written(counts(train), "counts")
    facts = known(table)
    model = trained(train, facts)
    base_all = float(np.log10(facts.tokens + facts.types + 1))
    local = np.zeros(len(facts.count))
    rare = facts.own == CLASSES
    if facts.rest:
        local[rare] = np.log10((facts.count[rare] - facts.discount) / facts.rest)

    def rated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, n, words in row_words(batch.column(3)):
                n -= lo
                hashes, bounds = _tokens(words)
                row = np.repeat(np.arange(n), np.diff(bounds))
                place = facts.find(hashes)
                kinds = facts.classes(place)
                context = contexts(kinds, bounds)
                code = context[:, 0] * (CLASSES + 2) + context[:, 1]
                distinct, at = np.unique(code, return_inverse=True)
                order = np.argsort(at, kind="stable")
                cuts = np.searchsorted(at[order], np.arange(0, len(distinct) + BATCH, BATCH))
                shares = np.empty(len(kinds))
                for k in range(0, len(distinct), BATCH):
                    some = order[cuts[k // BATCH]:cuts[k // BATCH + 1]]
                    part = distinct[k:k + BATCH]
                    logs = model.log_shares(np.stack([part // (CLASSES + 2), part % (CLASSES + 2)], 1))
                    shares[some] = logs[at[some] - k, kinds[some]]
                there = place >= 0
                base = np.bincount(row[there], np.log10(facts.count[place[there]] + 1.0), n)
                score = np.bincount(row, shares / np.log(10), n) + np.bincount(row[there], local[place[there]], n)
                # Of rarer words only the hash and the number go on.
                far = np.flatnonzero(~there)
                key = np.lexsort((hashes[far], row[far]))
                r, h = row[far][key], hashes[far][key]
                new = np.ones(len(r), bool)
                new[1:] = (r[1:] != r[:-1]) | (h[1:] != h[:-1])
                number = np.diff(np.append(np.flatnonzero(new), len(r)))
                ends = np.concatenate([[0], np.cumsum(np.bincount(r[new], minlength=n))])
                words_of = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(
                    [pa.array(h[new].view(np.int64)), pa.array(number.astype(np.int64))], ["w", "n"]))
                yield pa.record_batch(
                    [batch.column(k).slice(lo, n) for k in range(3)] + [
                        pa.array(np.diff(bounds)), pa.array(np.bincount(row[there], minlength=n)),
                        pa.array(base), pa.array(score), words_of],
                    ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "far"])
    kind = dict(df.dtypes)["doc_id"]
    placed = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "text")
    rows = written(placed.mapInArrow(
        rated, f"row long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, base double, score double, "
        "far array<struct<w:long,n:long>>"), "rated")
    far = rows.select("row", F.inline("far")).join(table, "w", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    more = far.groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("known2"),
        F.sum(F.col("n") * F.log10(F.col("c") + F.lit(1.0))).alias("base2"),
        F.sum(F.col("n") * _share_of_rest(F.col("c"), facts)).alias("score2"))
    zero = F.lit(0.0)
    return rows.drop("far").join(more, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known2", F.lit(0))).cast("long").alias("n_known"),
        F.lit(facts.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("base2", zero) - F.col("n_tokens") * F.lit(base_all)).alias("base_score"),
        (F.col("score") + F.coalesce("score2", zero)).alias("score"))
