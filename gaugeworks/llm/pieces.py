"""SentencePiece models on the tokenizers library: encoding, decoding and parity.

The model file is read field by field; normaliser, word marker, scores or merges and
byte fallback are rebuilt for the other library, which encodes whole batches, in
workers on one thread.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from gaugeworks.llm.store import fresh, given_back, kept

MARK = "▁"
# Fixed values of the file format: kinds of model and of piece.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Texts given to the library at once, by characters.
BATCH_CHARS = 1 << 17
#: Distinct words a Python worker keeps the pieces of.
MOST_WORDS = 80_000
#: Bytes of text whose rows go back at once.
SENT_BYTES = 1 << 20


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
            continue
        if kind not in (1, 2, 5):
            raise ValueError(f"field of kind {kind} in a model file")
        size = {1: 8, 5: 4}.get(kind) or (number() if kind == 2 else 0)
        yield key >> 3, data[at:at + size]
        at += size


@dataclass
class Model:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze: bool = True
    suffix_mark: bool = False

    def first(self, kind: int) -> int | None:
        return next((i for i, p in enumerate(self.pieces) if p[2] == kind), None)


def parse(data: bytes) -> Model:
    """The parts of a model file that encoding needs."""
    model = Model()
    for number, value in _fields(data):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for n, v in _fields(value):
                if n == 1:
                    piece = v.decode()
                elif n == 2:
                    score = struct.unpack("<f", v)[0]
                elif n == 3:
                    kind = v
            model.pieces.append((piece, score, kind))
        elif number == 2:
            for n, v in _fields(value):
                if n == 3:
                    model.kind = v
                elif n == 24:
                    model.suffix_mark = bool(v)
                elif n == 35:
                    model.byte_fallback = bool(v)
        elif number == 3:
            for n, v in _fields(value):
                if n == 2:
                    model.charsmap = v
                elif n == 3:
                    model.dummy_prefix = bool(v)
                elif n == 4:
                    model.squeeze = bool(v)
    return model


def _merges(model: Model) -> list[tuple[str, str]]:
    """The pairs of pieces that make a piece, best score first."""
    made = {p: s for p, s, kind in model.pieces if kind == NORMAL}
    place = {p: i for i, (p, _, _) in enumerate(model.pieces)}
    pairs = [(-score, place[p[:k]], place[p[k:]], p[:k], p[k:]) for p, score in made.items()
             for k in range(1, len(p)) if p[:k] in made and p[k:] in made]
    return [(a, b) for _, _, _, a, b in sorted(pairs)]


def tokenizer(model: Model):
    """The same model in the tokenizers library."""
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    if model.suffix_mark or model.kind not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models with the marker before a word are supported")
    unknown = model.first(UNKNOWN)
    # A piece that text may never match keeps its id under a name no text has.
    names = [p if kind in (NORMAL, USER_DEFINED) or (kind == BYTE and model.byte_fallback) or i == unknown
             else f"\U0010fffd{i}\U0010fffd" for i, (p, _, kind) in enumerate(model.pieces)]
    if model.kind == BPE:
        core = models.BPE(vocab={p: i for i, p in enumerate(names)}, merges=_merges(model), fuse_unk=True,
                          unk_token=None if unknown is None else names[unknown], byte_fallback=model.byte_fallback)
    else:
        core = models.Unigram([(p, s) for p, (_, s, _) in zip(names, model.pieces)], unknown, model.byte_fallback)
    made = Tokenizer(core)
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.squeeze:
        steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(MARK))
    made.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", MARK)])
    # No merge can cross from a word into the next one's marker unless a piece holds both.
    if not any(a != MARK and b == MARK for p, _, kind in model.pieces if kind == NORMAL for a, b in zip(p, p[1:])):
        made.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}*[^{MARK}]+|{MARK}+"), "removed", invert=True)
    made.decoder = decoders.Sequence([
        decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(),
        *([decoders.Strip(" ", 1, 0)] if model.dummy_prefix else [])])
    own = [AddedToken(p, normalized=True, special=False) for p, _, kind in model.pieces if kind == USER_DEFINED]
    if own:
        made.add_tokens(own)
    return made


class Codec:
    """A model's tokenizer, with the words met so far and the bytes of each piece.

    Where no piece reaches over a word's end, a text is the sequence of its words'
    pieces; each distinct word is encoded once and kept, up to MOST_WORDS of them.
    """

    def __init__(self, model: Model):
        from tokenizers import Tokenizer

        self.whole = tokenizer(model)
        self.by_word = self.whole.pre_tokenizer is not None and not any(
            kind == USER_DEFINED for _, _, kind in model.pieces)
        self.core = Tokenizer(self.whole.model)
        self.plain = not model.charsmap and not model.squeeze
        self.prefix = MARK if model.dummy_prefix else ""
        self.words = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
        self._forget()
        unknown = " \u2047 ".encode()
        parts = [bytes([int(p[3:5], 16)]) if kind == BYTE else b"" if kind == CONTROL else unknown if kind == UNKNOWN
                 else p.replace(MARK, " ").encode() for p, _, kind in model.pieces]
        self.piece_bytes = np.frombuffer(b"".join(parts), np.uint8)
        self.piece_size = np.array([len(x) for x in parts], np.int64)
        self.piece_start = np.cumsum(self.piece_size) - self.piece_size

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.size, self.start = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _learn(self, words: list[str]) -> None:
        made = self.core.encode_batch_fast(words, add_special_tokens=False)
        got = [x.ids for x in made]
        size = np.array([len(x) for x in got], np.int64)
        self.known.update(zip(words, range(len(self.size), len(self.size) + len(words))))
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.ids = np.concatenate([self.ids, np.fromiter((i for x in got for i in x), np.int32, int(size.sum()))])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, pieces of each text)."""
        if not self.by_word:
            got = [x.ids for x in self.whole.encode_batch_fast(texts, add_special_tokens=False)]
            return np.concatenate([np.zeros(0, np.int32), *(np.array(x, np.int32) for x in got)]), np.array(
                [len(x) for x in got], np.int64)
        normal = ([self.prefix + x.replace(" ", MARK) if x else "" for x in texts] if self.plain
                  else [self.whole.normalizer.normalize_str(x) for x in texts])
        lists = [self.words.findall(x) for x in normal]
        words = list(chain.from_iterable(lists))
        if len(self.known) > MOST_WORDS:
            self._forget()
        new = [w for w in dict.fromkeys(words) if w not in self.known]
        if new:
            self._learn(new)
        at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        ends = np.concatenate([[0], np.cumsum(self.size[at])])
        cuts = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
        return _gathered(self.ids, self.start[at], self.size[at]), np.diff(ends[cuts])

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """The texts of the id lists that end at `ends` (from 0)."""
        ids = ids.astype(np.int64)
        size = self.piece_size[ids]
        data = _gathered(self.piece_bytes, self.piece_start[ids], size)
        cuts = np.concatenate([[0], np.cumsum(size)])[ends]
        if self.prefix:  # the blank before the first word was not in the text
            first = np.zeros(len(data) + 1, bool)
            first[cuts[:-1][np.diff(cuts) > 0]] = True
            drop = first[:-1] & (data == 32)
            gone = np.concatenate([[0], np.cumsum(drop)])
            data, cuts = data[~drop], cuts - gone[cuts]
        made = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(data))
        try:
            made.validate(full=True)
            return made
        except pa.ArrowInvalid:  # bytes that are no text: each becomes a replacement character
            whole = data.tobytes()
            return pa.array([whole[a:b].decode("utf-8", "replace") for a, b in zip(cuts[:-1], cuts[1:])], pa.large_string())


def _gathered(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches of `flat`, one after the other."""
    before = np.cumsum(size) - size
    return flat[np.repeat(start - before, size) + np.arange(int(size.sum()))]


def loaded(path: str) -> Codec:
    """The codec of a model file, built once a Python worker and kept until it does other work."""
    if path not in kept:
        # A task has one core; the library's own threads would each keep memory of theirs.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(path, "rb") as file:
            kept[path] = Codec(parse(file.read()))
    return kept[path]


def _batches(texts: pa.Array) -> Iterator[list[str]]:
    """Successive texts of about BATCH_CHARS characters, null as empty; a longer text is a batch of its own."""
    batch, size = [], 0
    for text in texts:
        text = text.as_py() or ""
        if batch and size + len(text) > BATCH_CHARS:
            yield batch
            batch, size = [], 0
        batch.append(text)
        size += len(text)
    if batch:
        yield batch


def _encoded(codec: Codec, column: pa.Array) -> pa.ListArray:
    got = [codec.encode(batch) for batch in _batches(column)]
    ends = np.concatenate([[0], np.cumsum(np.concatenate([np.zeros(0, np.int64), *(g[1] for g in got)]))])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                    pa.array(np.concatenate([np.zeros(0, np.int32), *(g[0] for g in got)])))


def _decoded(codec: Codec, column: pa.ListArray) -> pa.Array:
    if column.null_count:
        column = column.fill_null([])
    ends = column.offsets.to_numpy().astype(np.int64)
    ids = column.values.to_numpy(zero_copy_only=False)
    parts, lo = [], 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + BATCH_CHARS, "right")) - 1)
        parts.append(codec.decode(ids[ends[lo]:ends[hi]], ends[lo:hi + 1] - ends[lo]))
        lo = hi
    return pa.concat_arrays([x.cast(pa.string()) for x in parts]) if parts else pa.array([], pa.string())


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """`df` with `ids`, an array of piece ids without begin or end; null and empty texts have none."""
    out, = fresh(df, ids)

    @F.arrow_udf("array<int>")
    def encoded(column: pa.Array) -> pa.Array:
        return _encoded(loaded(path), column)
    return df.withColumn(out, encoded(F.col(text)))


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """`df` with the text of its ids; null ids give an empty text."""
    out, = fresh(df, text)

    @F.arrow_udf("string")
    def decoded(column: pa.Array) -> pa.Array:
        return _decoded(loaded(path), column)
    return df.withColumn(out, decoded(F.col(ids)))


def both_ways(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """`df` with `ids` and `decoded`, each row encoded and decoded in one visit to Python.

    Rows go back some at a time, as many as SENT_BYTES of text, so a task holds no more than one batch it was given.
    """
    put = fresh(df, "ids", "decoded")
    at = df.columns.index(text)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given_back(keep=True)
        codec = loaded(path)
        given_back(keep=True)
        for batch in batches:
            size = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(size)])
            lo = 0
            while lo < len(batch):
                hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + SENT_BYTES, "right")) - 1)
                part = batch.slice(lo, hi - lo)
                ids = _encoded(codec, part.column(at))
                yield pa.RecordBatch.from_arrays([*part.columns, ids, _decoded(codec, ids)], [*batch.schema.names, *put])
                lo = hi
            given_back(keep=True)
    schema = StructType([*df.schema.fields, StructField(put[0], ArrayType(IntegerType())), StructField(put[1], StringType())])
    return df.mapInArrow(coded, schema)


def unlike(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """The rows of `df` whose ids are not those the model's own library gives."""
    @F.arrow_udf("boolean")
    def differs(texts: pa.Array, got: pa.Array) -> pa.Array:
        from sentencepiece import SentencePieceProcessor

        own = SentencePieceProcessor(model_file=path)
        return pa.array([own.encode(a.as_py() or "") != b.as_py() for a, b in zip(texts, got)], pa.bool_())
    return df.filter(differs(F.col(text), F.col(ids)))
