"""Filter audit, personal data and ranked search against brute force."""

import hashlib
import math
import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from gaugeworks.llm import interaction, personal, ranked

from .conftest import WORD, prose

LABELS = "doc_id long, quality int, toxic int, text string"


def brute_audit(rows, labels):
    first, out = {}, {}
    for r in rows:
        if r[0] is not None:
            first[r[1] or ""] = min(first.get(r[1] or "", r[0]), r[0])
    per = {}
    for r in rows:
        t = r[1] or ""
        w = WORD.findall(t)
        fails = {c for c, bad in zip("ABCDE", (
            len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            bool(re.search(r"[#$%&*|]", t)), r[0] is not None and r[0] > first[t])) if bad}
        good = any(x[0] == r[0] and x[1] == 1 for x in labels if x[0] is not None)
        toxic = any(x[0] == r[0] and x[2] == 1 for x in labels if x[0] is not None)
        per.setdefault(r[2] or "", []).append((fails, good, toxic))
    for part, docs in per.items():
        removed = Counter()
        for order in permutations("ABCDE"):
            left, gone = docs, []
            for k, c in enumerate(order):
                now = [d for d in left if c in d[0]]
                left = [d for d in left if c not in d[0]]
                removed[c] += len(now)
                out[part, "".join(order), k + 1] = [
                    len(left), len(now), sum(c in d[0] for d in gone), sum(d[0] == {c} for d in docs),
                    sum(d[1] for d in now), sum(d[2] for d in now)]
                gone = gone + now
        for (p, order, k), v in out.items():
            if p == part:
                v.append(removed[order[k - 1]])
    return out


@pytest.mark.parametrize("most", [interaction.MOST_BROADCAST, -1])
def test_audit(spark, docs, corpus, nothing, monkeypatch, most):
    monkeypatch.setattr(interaction, "MOST_BROADCAST", most)
    labels = [(1, 1, 0, "x"), (2, 0, 1, None), (2, 1, None, None), (None, 1, 1, None), (64, None, 1, None), (9999, 1, 1, None)]
    table = spark.createDataFrame(labels, LABELS)
    got = {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley]
           for r in interaction.audit(docs, table).collect()}
    assert got == brute_audit(corpus, labels)
    assert interaction.audit(nothing, table).count() == 0
    assert interaction.audit(docs, table.limit(0)).count() == len(got)


def test_sketch_clears_only_unique_texts(spark):
    rows = [(k, f"text {k % 900}") for k in range(1000)]
    got = interaction.screened(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 1000
    assert all(r.maybe for r in got if r.doc_id % 900 < 100)
    assert sum(r.maybe for r in got) < 300


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def brute_spans(text):
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": all(int(x) < 256 for x in m[0].split(".")) if kind == "ip" else 0,
                    "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]:
                yield f"{kind}:{m.start()}:{m.end()}"


ODD = ["a@b.c_x@d.e", "a@b @c.d x@y.z.", "1.2.3.4.5.6.7.8 999.1.1.1 0001.02.3.255", "4111 1111 1111 1111 4111-1111-1111-1111",
       "+1 (017) 555-7713 +12 +49 30 123456789012345", "😀 é a.b+c@mail.example.org 😀 10.0.0.1", "+1+2 345 678 90 1", "@", "+",
       "9" * 5000 + " x@" + "y" * 5000, "a" * 200_000 + "@", "1 2 " * 5000, "a@b." + "c." * 20_000 + "d", "4" * 16,
       "mail x@y.z 1.1.1.1 " * 400]


def test_base_spans(spark, docs, nothing):
    rows = [(k, t) for k, t in enumerate(ODD)] + [(100, None), (101, ""), (None, ODD[0]), (0, ODD[0])]
    got = personal.personal(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = {k: list(brute_spans(t)) for k, t in rows}
    assert len(got) == len(rows)
    for r in got:
        spans = want[r.doc_id] if r.doc_id is not None else want[0]
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k) for s in spans) for k in BASE]
        assert set(spans) <= set(r.spans.split(",")) and (not r.spans or len(r.spans.split(",")) == len(spans) + r.n_found)
    assert personal.personal(docs).count() == docs.count() and personal.personal(nothing).count() == 0


def test_trusted_patterns_find_what_no_rule_knows(spark):
    rng = random.Random(4)
    rows = [(k, f"{prose(rng, 20)} reach me at user{k}@mail.example.com thanks {prose(rng, 5)} room number {k} there") for k in range(40)]
    rows += [(100, f"{prose(rng, 9)} reach me at user77(at)mail7 thanks {prose(rng, 5)}"), (101, "room number 7 there"),
             (102, f"{prose(rng, 9)} Reach me at \"user78#mail\", thanks")]
    got = {r.doc_id: r for r in personal.personal(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    text = dict(rows)
    for k, hidden in ((100, "user77(at)mail7"), (102, "user78#mail")):
        at = text[k].index(hidden)
        assert got[k].spans == f"email:{at}:{at + len(hidden)}" and (got[k].n_found, got[k].n_email) == (1, 0)
    assert not got[101].spans and all(got[k].n_found == 0 and got[k].n_email == 1 for k in range(40))


def brute_trust(edges, rounds):
    """edges: (pattern, inst, kind or None)."""
    size, degree = Counter(p for p, _, _ in edges), Counter(i for _, i, k in edges if k is None)
    seeds = Counter((p, k) for p, _, k in edges if k is not None)
    trust = {x: n / (size[x[0]] + personal.DOUBT) for x, n in seeds.items()}
    for _ in range(rounds):
        score = Counter()
        for p, i, k in edges:
            if k is None:
                for kind in range(4):
                    score[i, kind] += trust.get((p, kind), 0) / degree[i]
        trust = {(p, k): (n + sum(score[i, k] for q, i, none in edges if q == p and none is None)) / (size[p] + personal.DOUBT)
                 for (p, k), n in seeds.items()}
    return {x: t for x, t in trust.items() if seeds[x] >= personal.LEAST_SEEDS and t >= personal.TRUST}


def test_trust_of_patterns(spark):
    rng = random.Random(8)
    kinds = {i: rng.choice([0, 0, 1, None]) for i in range(60)}
    edges = sorted({(f"p{rng.randrange(8)}", i, kinds[i]) for i in range(60) for _ in range(3)}, key=str)
    edges += [("q", 1000 + i, 2) for i in range(9)] + [("q", 2000, None)]
    table = spark.createDataFrame([(p, str(i), k) for p, i, k in edges], "pattern string, inst string, kind int")
    got = {r.pattern: (r.k, r.trust) for r in personal.trusted(table).collect()}
    want = brute_trust(edges, personal.ROUNDS)
    assert "q" in got and set(got) == {p for p, _ in want}
    assert all(math.isclose(t, max(x for (q, _), x in want.items() if q == p)) for p, (_, t) in got.items())


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate({65 + i: 97 + i for i in range(26)}))


def brute_ranks(rows, items, k=20):
    docs = [(r[0], terms(r[1])) for r in rows]
    docs = [(i, Counter(t), len(t)) for i, t in docs if t]
    n, length = len(docs), sum(x[2] for x in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, size in docs:
            m = 75 + 25 * size * n // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in terms(text) if c[t])
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out += [(item, rank, None if none else i, -s) for rank, (s, none, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("per_pass", [ranked.PASS, 4])
def test_ranked(spark, docs, corpus, nothing, monkeypatch, per_pass):
    monkeypatch.setattr(ranked, "PASS", per_pass)
    monkeypatch.setattr(ranked, "CELLS", 4000)
    items = [(k, corpus[k * 5][1], "y") for k in range(12)] + [(50, "one ONE one two", "y"), (51, "", None), (52, None, None),
             (None, "é ü shared passage", None), (50, "unknownword", None), (53, "x" * 300_000 + " corpus", None), (0, corpus[0][1], "y")]
    table = spark.createDataFrame(items, "item_id long, text string, rank string")
    got = sorted((tuple(r) for r in ranked.search(docs, table).collect()), key=str)
    assert got == brute_ranks(corpus, [x[:2] for x in items])
    assert ranked.search(nothing, table).count() == 0 and ranked.search(docs, table.limit(0)).count() == 0


def test_balls_hold_their_rows_and_prune(spark):
    rng = np.random.default_rng(2)
    centres = rng.integers(0, 1000, (20, 60)) * (rng.random((20, 60)) < 0.2)
    x = np.repeat(centres, 40, axis=0) + rng.integers(0, 3, (800, 60))
    weight = np.sort(rng.integers(1, 50, 60))[::-1].copy()
    queries = ranked.Queries.of([{int(t): 1 for t in np.flatnonzero(c)[:6]} for c in centres], weight)
    tree = ranked.grown(x * queries.scale, queries.group)
    assert sorted(tree.order) == list(range(800))
    best = [ranked.Best(5) for _ in centres]
    scored = ranked.searched(x.astype(np.int64), list(range(800)), queries, best)
    for q, top in enumerate(best):
        exact = x[:, queries.columns[q]] @ queries.weights[q]
        want = sorted(((-s, i) for i, s in enumerate(exact.tolist()) if s > 0))[:5]
        assert sorted((-s, i) for s, i in top.rows()) == want
    assert scored < 0.5 * 800 * len(centres)


def test_terms_are_cut_nowhere():
    text = ("wörd Word2 " * 300_000) + "x" * 2_000_000 + " end"
    assert [t.decode() for t in ranked.terms(text)] == terms(text)


def test_vocabulary_compares_bytes(spark):
    vocabulary = ranked.Vocabulary([b"ab", b"abc"])
    data = np.frombuffer(b"ab abc abd", np.uint8)
    (hashes, starts, ends), = ranked.found(data)
    hashes[2] = hashes[1]
    at, term = vocabulary.numbers(data, hashes, starts, ends)
    assert at.tolist() == [0, 1] and [vocabulary.words[t] for t in term] == [b"ab", b"abc"]
