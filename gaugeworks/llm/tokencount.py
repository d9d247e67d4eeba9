"""Token counts of byte-level BPE by compiled finite-state transducers.

The splitting pattern is a transducer over character classes whose transitions carry
the word starts they prove. Texts are cut into chunks; each chunk's map from state to
state is worked out for all states at once, the maps compose by a prefix scan, and a
last pass from the now known states reads the starts off. Inside a word, tokens are
states: a token may follow another where no merge would reach across the two, which
leaves one path through the word, and each step of it adds one to the count.
"""

from __future__ import annotations

import json
import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.store import fresh
from gaugeworks.llm.words import mixed, powers

#: Characters handled at once, and characters of a chunk.
BATCH_CHARS, CHUNK_CHARS = 1 << 19, 256
#: Words longer than this are walked one by one.
LONG_WORD = 48
KNOWN = 1 << 20

# Classes of characters: letters that can end a contraction apart, digits, blank,
# other white space, apostrophe, the rest, and the end of a text.
LETTER, STMD, R, V, L_, E, DIGIT, BLANK, SPACE, QUOTE, OTHER, END = range(12)
# States: what the last characters were.
START, IN_LETTERS, IN_DIGITS, IN_OTHER, ONE_BLANK, ONE_SPACE, TO_BLANK, TO_SPACE, QUOTED, Q_R, Q_V, Q_L, CONTRACTED = range(13)
N_STATES, N_CLASSES = 13, 12
#: Bits of a transition: a word starts at this character, or at the one before.
HERE, BEFORE = 1, 2


@cache
def classes() -> np.ndarray:
    """The class of each code point."""
    made = np.full(0x110000, OTHER, np.uint8)
    for code in range(0x110000):
        kind = unicodedata.category(chr(code))[0]
        if kind in "LN":
            made[code] = LETTER if kind == "L" else DIGIT
    # The code points Unicode calls white space.
    for low, high in ((9, 13), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029),
                      (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)):
        made[low:high + 1] = SPACE
    made[32], made[39] = BLANK, QUOTE
    for letters, kind in (("stmd", STMD), ("r", R), ("v", V), ("l", L_), ("e", E)):
        for letter in letters:
            made[ord(letter)] = kind
    return made


@cache
def transducer() -> tuple[np.ndarray, np.ndarray]:
    """(next state, flags) by state * N_CLASSES + class."""
    go = np.zeros((N_STATES, N_CLASSES), np.int16)
    flags = np.zeros((N_STATES, N_CLASSES), np.uint8)
    letters = (LETTER, STMD, R, V, L_, E)
    run_of = {c: IN_LETTERS for c in letters} | {DIGIT: IN_DIGITS, OTHER: IN_OTHER}

    def arrive(state: int, kind: int) -> tuple[int, int]:
        """Where a character leads from a state with nothing pending."""
        if kind == END:
            return START, 0
        if kind in (BLANK, SPACE):
            if state in (ONE_BLANK, ONE_SPACE, TO_BLANK, TO_SPACE):
                return (TO_BLANK if kind == BLANK else TO_SPACE), 0
            return (ONE_BLANK if kind == BLANK else ONE_SPACE), HERE
        # White space before a word: its last character is cut off, a blank joins the word.
        flag = {ONE_BLANK: 0, TO_BLANK: BEFORE, TO_SPACE: BEFORE | HERE}.get(state, HERE)
        if kind == QUOTE:
            if state in (ONE_BLANK, TO_BLANK):
                return IN_OTHER, flag
            return (IN_OTHER, 0) if state == IN_OTHER else (QUOTED, flag)
        return run_of[kind], 0 if run_of[kind] == state else flag

    for state in range(N_STATES):
        for kind in range(N_CLASSES):
            if state == QUOTED:
                if kind == STMD:
                    to = CONTRACTED, 0
                elif kind in (R, V, L_):
                    to = {R: Q_R, V: Q_V, L_: Q_L}[kind], 0
                elif kind in (OTHER, QUOTE):
                    to = IN_OTHER, 0
                else:
                    to = arrive(IN_OTHER, kind)
            elif state in (Q_R, Q_V, Q_L):
                if kind == (L_ if state == Q_L else E):
                    to = CONTRACTED, 0
                else:  # no contraction: the letter began a word
                    goal, flag = arrive(IN_LETTERS, kind)
                    to = goal, flag | BEFORE
            else:
                to = arrive(state, kind)
            go[state, kind], flags[state, kind] = to
    return go.ravel(), flags.ravel()


def word_starts(kinds: np.ndarray) -> np.ndarray:
    """True where a word starts, for the classes of texts that each end with END."""
    go, flags = transducer()
    n = len(kinds)
    width = -(-n // CHUNK_CHARS)
    grid = np.full(width * CHUNK_CHARS, END, np.int16)
    grid[:n] = kinds
    steps = np.ascontiguousarray(grid.reshape(width, CHUNK_CHARS).T)
    maps = np.tile(np.arange(N_STATES, dtype=np.int16)[:, None], (1, width))
    for step in steps:
        maps = go[maps * N_CLASSES + step]
    # Inclusive scan: after the round of stride s, maps[:, i] spans the 2 * s chunks up to i.
    stride = 1
    while stride < width:
        later = maps[:, stride:]
        maps = np.concatenate([maps[:, :stride], np.take_along_axis(later, maps[:, :-stride].astype(np.int64), 0)], 1)
        stride *= 2
    state = np.concatenate([[START], maps[START, :-1]]).astype(np.int16)
    seen = np.empty((CHUNK_CHARS, width), np.uint8)
    for k, step in enumerate(steps):
        at = state * N_CLASSES + step
        seen[k], state = flags[at], go[at]
    seen = seen.T.ravel()[:n]
    starts = (seen & HERE) > 0
    starts[:-1] |= (seen[1:] & BEFORE) > 0
    return starts


class Counter:
    """Counts of the tokens of words, for one vocabulary."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        model = held["model"]
        if held.get("normalizer") or held["pre_tokenizer"]["type"] != "ByteLevel" or held["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError("only byte-level BPE without normaliser and added blank is supported")
        self.special = [x["content"] for x in held["added_tokens"]]
        # The alphabet stands for bytes: printable ones for themselves, the others from 256 on.
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
        names = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
        number = {x: names[x] for x in names}
        text = [bytes([b]) for b in range(256)]
        left, right = list(range(256)), list(range(256))
        for k, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            number.setdefault(a + b, 256 + k)
            left.append(number[a])
            right.append(number[b])
            text.append(text[number[a]] + text[number[b]])
        # A token's number is the time of its merge; bytes are there from the start.
        self.left, self.right = np.array(left), np.array(right)
        self.longest = max(map(len, text))
        keys = (self.left[256:] << 20) | self.right[256:]
        order = np.argsort(keys, kind="stable")
        self.pair_key, self.pair_made = keys[order], order + 256
        self.pair_near = np.zeros(1 << 20, bool)
        self.pair_near[self._near(keys)] = True
        hashes = np.array([self._hash_of(x) for x in text], np.uint64)
        first = np.unique(hashes, return_index=True)
        self.token_hash, self.token = first
        self.token_near = np.zeros(1 << 20, bool)
        self.token_near[hashes >> np.uint64(44)] = True
        self.known_word, self.known_count = np.zeros(KNOWN, np.uint64), np.zeros(KNOWN, np.int64)
        self.known_pair, self.known_fit = np.full(KNOWN, -1, np.int64), np.zeros(KNOWN, bool)

    @staticmethod
    def _near(keys: np.ndarray) -> np.ndarray:
        return (mixed(keys.astype(np.uint64)) >> np.uint64(44)).astype(np.int64)

    @staticmethod
    def _hash_of(word: bytes) -> int:
        up, _ = powers(len(word) + 1)
        return mixed(((np.frombuffer(word, np.uint8).astype(np.uint64) + np.uint64(1)) * up[:len(word)]).sum(keepdims=True))[0]

    def _merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The token each pair merges into, or one beyond all."""
        keys = (a << 20) | b
        out = np.full(len(keys), 1 << 40)
        maybe = np.flatnonzero(self.pair_near[self._near(keys)])
        if len(maybe):
            at = np.minimum(np.searchsorted(self.pair_key, keys[maybe]), len(self.pair_key) - 1)
            hit = self.pair_key[at] == keys[maybe]
            out[maybe[hit]] = self.pair_made[at[hit]]
        return out

    def _fits_slow(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether no merge reaches from token `a` into token `b`.

        Going back in time, the later of the two facing parts is undone until both
        are bytes. A merge of the facing parts that would come before the merges
        that used them (the left one of equals first) reaches across.
        """
        fits = np.ones(len(a), bool)
        live = np.arange(len(a))
        x, y = a.copy(), b.copy()
        x_used, y_used = np.full(len(a), 1 << 30), np.full(len(a), 1 << 30)
        while len(live):
            m = self._merged(x, y)
            across = (m < x_used) & (m <= y_used)
            fits[live[across]] = False
            keep = ~across & ((x >= 256) | (y >= 256))
            live, x, y, x_used, y_used = live[keep], x[keep], y[keep], x_used[keep], y_used[keep]
            undo_x = x > y
            x_used, y_used = np.where(undo_x, x, x_used), np.where(undo_x, y_used, y)
            x, y = np.where(undo_x, self.right[x], x), np.where(undo_x, y, self.left[y])
        return fits

    def _fits(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = (a << 20) | b
        slot = self._near(keys)
        out = self.known_fit[slot]
        new = self.known_pair[slot] != keys
        if new.any():
            some, at = np.unique(keys[new], return_inverse=True)
            fit = self._fits_slow(some >> 20, some & ((1 << 20) - 1))
            out[new] = fit[at]
            self.known_pair[self._near(some)] = some
            # Where two share a slot both arrays hold the last.
            self.known_fit[self._near(some)] = fit
        return out

    def _tokens(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The token that stretches of bytes are, or -1."""
        _, down = powers(len(sums))
        h = mixed((sums[end] - sums[start]) * down[start])
        out = np.full(len(h), -1)
        maybe = np.flatnonzero(self.token_near[(h >> np.uint64(44)).astype(np.int64)])
        if len(maybe):
            at = np.minimum(np.searchsorted(self.token_hash, h[maybe]), len(self.token_hash) - 1)
            hit = self.token_hash[at] == h[maybe]
            out[maybe[hit]] = self.token[at[hit]]
        return out

    def _walk(self, sums: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Tokens of each word: for each end in turn, the one last token that may stand there."""
        order = np.argsort(-size, kind="stable")
        start, size = start[order], size[order]
        longest = int(size[0]) if len(size) else 0
        last, count = np.full((longest + 1, len(size)), -1), np.zeros((longest + 1, len(size)), np.int64)
        for i in range(1, longest + 1):
            open_ = np.arange(np.searchsorted(-size, -i, "right"))
            for width in range(min(i, self.longest), 0, -1):
                if not len(open_):
                    break
                token = self._tokens(sums, start[open_] + i - width, start[open_] + i)
                some = np.flatnonzero(token >= 0)
                if width < i and len(some):
                    before = last[i - width, open_[some]]
                    some = some[self._fits(before, token[some])]
                done = open_[some]
                last[i, done], count[i, done] = token[some], count[i - width, done] + 1
                left = np.ones(len(open_), bool)
                left[some] = False
                open_ = open_[left]
        out = np.empty(len(size), np.int64)
        out[order] = count[size, np.arange(len(size))]
        return out

    def _walk_long(self, sums: np.ndarray, start: int, size: int) -> int:
        """Tokens of one long word."""
        widths = min(self.longest, size)
        by_end: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]
        places = np.arange(start, start + size)
        for width in range(widths, 0, -1):
            at = places[:size - width + 1]
            token = self._tokens(sums, at, at + width)
            for k in np.flatnonzero(token >= 0):
                by_end[k + width].append((width, int(token[k])))
        last, count = [-1] * (size + 1), [0] * (size + 1)
        fits: dict[tuple[int, int], bool] = {}
        for i in range(1, size + 1):
            for width, token in by_end[i]:
                pair = last[i - width], token
                if width < i and pair not in fits:
                    fits[pair] = bool(self._fits(np.array(pair[:1]), np.array(pair[1:]))[0])
                if width == i or fits[pair]:
                    last[i], count[i] = token, count[i - width] + 1
                    break
        return count[size]

    def of_words(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Tokens of the words of `data` (bytes), each at `start` with `size` bytes."""
        up, down = powers(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
        h = mixed((sums[start + size] - sums[start]) * down[start])
        slot = (h >> np.uint64(44)).astype(np.int64)
        out = self.known_count[slot]
        new = np.flatnonzero(self.known_word[slot] != h)
        if len(new):
            some, first, at = np.unique(h[new], return_index=True, return_inverse=True)
            begin, length = start[new[first]], size[new[first]]
            count = np.zeros(len(some), np.int64)
            short = length <= LONG_WORD
            if short.any():
                count[short] = self._walk(sums, begin[short], length[short])
            for k in np.flatnonzero(~short):
                count[k] = self._walk_long(sums, int(begin[k]), int(length[k]))
            out[new] = count[at]
            where = (some >> np.uint64(44)).astype(np.int64)
            self.known_word[where], self.known_count[where] = some, count
        return out

    def of_texts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text; a special token's string counts as that one token."""
        extra = np.zeros(len(texts), np.int64)
        owner, parts = [], []
        for i, text in enumerate(texts):
            cut = [text]
            for name in self.special:
                cut = [piece for x in cut for piece in x.split(name)]
            extra[i] = len(cut) - 1
            owner += [i] * len(cut)
            parts += cut
        # Each part is followed by a code point no text holds, which ends it.
        codes = np.frombuffer("\0".join([*parts, ""]).encode("utf-32-le"), np.uint32)
        ends = np.cumsum([len(x) + 1 for x in parts]) - 1
        kinds = classes()[codes]
        kinds[ends] = END
        starts = np.flatnonzero(word_starts(kinds))
        wide = 1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)
        place = np.concatenate([[0], np.cumsum(wide)])
        data = np.frombuffer("\0".join([*parts, ""]).encode(), np.uint8)
        part = np.searchsorted(ends, starts)
        stop = np.minimum(np.append(starts[1:], len(codes)), ends[part])
        tokens = self.of_words(data, place[starts], place[stop] - place[starts])
        return extra + np.bincount(np.array(owner)[part], tokens, len(texts)).astype(np.int64)


_held: dict[str, Counter] = {}


def _counter(path: str) -> Counter:
    if path not in _held:
        _held[path] = Counter(path)
    return _held[path]


def counted(df: DataFrame, path: str, limit: int, text: str = "text") -> DataFrame:
    """`df` with n_bytes (UTF-8), n_tokens and over_limit for the vocabulary file at `path`.

    A null or empty text has 0 bytes and 0 tokens. A column already called like a
    result stays; the result gets an underscore before it.
    """
    put = fresh(df, "n_bytes", "n_tokens", "over_limit")

    @F.arrow_udf("long")
    def tokens(column: pa.Array) -> pa.Array:
        counter, made, batch, size = _counter(path), [np.zeros(0, np.int64)], [], 0
        for x in column:
            x = x.as_py() or ""
            if batch and size + len(x) > BATCH_CHARS:
                made.append(counter.of_texts(batch))
                batch, size = [], 0
            batch.append(x)
            size += len(x)
        if batch:
            made.append(counter.of_texts(batch))
        return pa.array(np.concatenate(made))
    return (df.withColumn(put[0], F.coalesce(F.octet_length(text), F.lit(0)).cast("long"))
            .withColumn(put[1], tokens(F.col(text))).withColumn(put[2], F.col(put[1]) > limit))
