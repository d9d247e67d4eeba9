"""Joins, line dedup and neighbours against brute force."""

import random
from itertools import combinations

import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F

from gaugeworks.llm import jaccard, lines, neighbours, queries
from gaugeworks.llm.components import components

from .conftest import words


def grouped(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return [find(k) for k in range(n)]


def test_components_of_a_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 120)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len({got[k] for k in range(41)}) == 1 and len({got[k] for k in range(100, 120)}) == 1 and got[0] != got[100]


def test_join_links_all_that_brute_force_links(docs, corpus):
    sets = []
    for row in corpus:
        w = words(row[1])
        sets.append(frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[k:k + 5]) for k in range(len(w) - 4)]))
    links = [(a, b) for a, b in combinations(range(len(sets)), 2)
             if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    group = grouped(len(sets), links)
    least = {}
    for k, row in enumerate(corpus):
        if row[0] is not None:
            least[group[k]] = min(row[0], least.get(group[k], row[0]))
    want = sorted((repr(row[0]), len(sets[k]), repr(least.get(group[k]) if sets[k] else row[0])) for k, row in enumerate(corpus))
    got = sorted((repr(r.doc_id), r.n_shingles, repr(r.component_id)) for r in jaccard.linked(docs).collect())
    assert got == want
    kept = jaccard.deduplicated(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({group[k] for k in range(len(sets)) if sets[k]}) + sum(not s for s in sets)


def test_join_of_a_group_without_a_centre(spark):
    """Near copies that link in a chain only are one component."""
    rng = random.Random(2)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for k in range(40):
        base = list(base)
        base[rng.randrange(120)] = f"n{k}"
        rows.append((k, " ".join(base)))
    got = {r.component_id for r in jaccard.linked(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {0}


def test_tiles_find_all_that_pairs_find(spark, monkeypatch):
    """One large group, most of it just too far apart, with chains of links and sets of many sizes."""
    rng = random.Random(12)
    base = [f"w{k}" for k in range(90)]
    rows = []
    for k in range(160):
        w = list(base) + [f"x{k}.{i}" for i in range(rng.choice([0, 0, 8, 25, 60]))]
        for _ in range(rng.choice([1, 2, 3, 4, 5, 6])):
            w[rng.randrange(90)] = f"n{rng.randrange(400)}"
        rows.append((k, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sets = [frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) for w in (words(t) for _, t in rows)]
    links = [(a, b) for a, b in combinations(range(len(sets)), 2) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    want = grouped(len(sets), links)
    for few, tile in ((0, 16), (12, 1024), (10**9, 1024)):
        monkeypatch.setattr(jaccard, "FEW", few)
        monkeypatch.setattr(jaccard, "TILE_SETS", tile)
        assert [r.component_id for r in jaccard.linked(df).orderBy("doc_id").collect()] == want


def test_tiles_leave_out_no_link():
    rng = np.random.default_rng(3)
    pool = np.sort(rng.integers(0, 1 << 60, 300).astype(np.uint64))
    sets = [np.sort(rng.choice(pool, rng.integers(225, 270), replace=False)) for _ in range(40)]
    size = np.array([len(x) for x in sets])
    bits = jaccard._folded([jaccard._bitmap(x, jaccard.TILE_BITS) for x in sets])
    every = np.arange(40)
    got = set(jaccard._tile_pairs(every, every, bits, size << 32, every.copy()))
    links = {(a, b) for a, b in combinations(range(40), 2)
             if 175 * len(np.intersect1d(sets[a], sets[b])) >= 75 * (size[a] + size[b])}
    assert links and links <= got and len(got) < 2 * 0.9 * len(list(combinations(range(40), 2)))


def test_empty_tables(nothing):
    assert jaccard.linked(nothing).count() == 0
    assert lines.counted(nothing).count() == 0 and lines.deduplicated(nothing).count() == 0


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_banded_distance():
    rng = random.Random(4)
    for _ in range(3000):
        a = "".join(rng.choice("abc") for _ in range(rng.randint(0, 12)))
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            k = rng.randint(0, len(b))
            b[k:k + rng.randint(0, 1)] = [rng.choice("abc")] * rng.randint(0, 1)
        assert lines.within(a, "".join(b)) == (distance(a, "".join(b)) <= lines.ERRORS)


def test_lines_against_all_pairs(spark):
    rng = random.Random(9)
    stock = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(20, 40))) for _ in range(30)]

    def bent(x):
        x = list(x)
        for _ in range(rng.randint(0, 3)):
            x[rng.randrange(len(x))] = rng.choice("xyz")
        return "".join(x)
    rows = [(k, "\n".join(bent(rng.choice(stock)) for _ in range(4))) for k in range(60)] + [(60, None), (61, ""), (62, "short\nshort")]
    every = [(i, j, x) for i, (_, t) in enumerate(rows) for j, x in enumerate((t or "").split("\n")) if len(x) >= lines.LEAST_CHARS]
    near = [(a, b) for a, b in combinations(range(len(every)), 2) if distance(every[a][2], every[b][2]) <= 2]
    group = grouped(len(every), near)
    gone = [sum(1 for n, (i, _, _) in enumerate(every) if i == k and group[n] != n) for k in range(len(rows))]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r.n_removed for r in lines.counted(df).collect()}
    assert [got[k] for k in range(len(rows))] == gone
    texts = {r.doc_id: r.text for r in lines.deduplicated(df).collect()}
    assert texts[60] is None and texts[61] == "" and texts[62] == "short\nshort"
    for k, (_, text) in enumerate(rows[:60]):
        stay = {(i, j) for n, (i, j, _) in enumerate(every) if group[n] != n}
        want = "\n".join(x for j, x in enumerate(text.split("\n")) if (k, j) not in stay)
        assert texts.get(k, "") == want or not want.strip()


def test_short_lines_go_as_exact_copies(spark):
    rows = [(0, "short\nshort\nshorn\n \n \n\n\nx"), (1, "Short\nx\nshort"), (2, "x"), (3, None), (4, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {r.doc_id: (r.n_lines, r.n_removed, r.n_chars) for r in lines.counted(df, lines.ANY).collect()}
    assert got == {0: (8, 1, 19), 1: (3, 2, 5), 2: (1, 1, 0), 3: (0, 0, 0), 4: (1, 0, 0)}
    texts = {r.doc_id: r.text for r in lines.deduplicated(df, lines.ANY).collect()}
    assert texts == {0: "short\nshorn\n \n \n\n\nx", 1: "Short", 3: None, 4: ""}


def test_the_registered_jobs_take_short_lines(spark, tmp_path):
    folder, stages = str(tmp_path), dict(corpus_pipeline.STAGES)
    spark.createDataFrame([(0, "one"), (1, "two"), (2, "one")], "doc_id long, text string").coalesce(1).write.parquet(
        f"{folder}/documents.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert sorted(r.n_removed for r in queries.QUERIES["op8_lines"](spark, folder).collect()) == [0, 0, 1]
    assert sorted(r.text for r in stages["line_dedup"](spark, docs, folder).collect()) == ["one", "two"]


def test_neighbours_recall_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(1)
    v = rng.standard_normal((700, 16)).astype(np.float32)
    v[100:160] = v[100]
    rows = [(k, x.tolist()) for k, x in enumerate(v)]
    odd = [(900, None), (1000, [0.0] * 16), (1100, [float("nan")] * 16), (1200, [None] * 16), (1300, []), (None, [1.0] * 16)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>")
    got = {}
    for r in neighbours.search(df, F.col("id") % 50 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hits = 0
    for q in range(0, 700, 50):
        d = np.sqrt(((v.astype(float) - v[q].astype(float)) ** 2).sum(1))
        want = [int(k) for k in np.lexsort((np.arange(700), d)) if k != q][:10]
        mine = sorted(got[q])
        assert [m[0] for m in mine] == list(range(1, 11))
        assert all(abs(m[2] - d[m[1]]) < 1e-9 for m in mine)
        hits += len({m[1] for m in mine} & set(want))
    assert hits >= 0.9 * 140 and set(got) == set(range(0, 700, 50))
    assert [m[1] for m in sorted(got[100])] == list(range(101, 111))
    few = spark.createDataFrame(rows[:4], "vec_id long, embedding array<float>")
    assert neighbours.search(few, F.col("id") == 0).count() == 3
    assert neighbours.search(few.limit(0), F.col("id") == 0).count() == 0


def test_a_batch_of_texts_is_read_a_stretch_at_a_time():
    import tracemalloc

    import pyarrow as pa

    texts = [None, "", "two\nlines é"] + ["a line of a long text\n" * 450] * 4000
    column = pa.array(texts)
    tracemalloc.start()
    try:
        read = [(lo, rows, joined.count("\n") + 1) for lo, rows, *_, joined in lines._lines(column)]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(rows for _, rows, _ in read) == len(texts) and sum(n for *_, n in read) == 4 + 4000 * 451
    assert peak < 24 << 20


def test_what_a_worker_keeps_between_tasks():
    import subprocess
    import sys
    from pathlib import Path

    import pyarrow as pa

    # A process of its own: threads and tables are made once.
    code = """if True:
        import os, public_tokenizers
        from gaugeworks.llm import pieces, store, words
        from gaugeworks.llm.queries import SENTENCEPIECE
        words.powers((1 << 18) + 1)
        assert sum(x.nbytes for x in words._powers) < 6 << 20
        path = public_tokenizers.path(SENTENCEPIECE)
        before = len(os.listdir("/proc/self/task"))
        pieces.loaded(path).encode([f"word{k} and {k} others" for k in range(3000)])
        assert len(os.listdir("/proc/self/task")) == before
        store.given_back(keep=True)
        assert path in store.kept
        store.given_back()
        assert not store.kept
    """
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(lines.__file__).parents[2])

    rng = np.random.default_rng(3)
    met, seen = np.zeros(0, np.uint64), set()
    for _ in range(50):
        names = np.unique(rng.integers(0, 3000, 90).astype(np.uint64))
        new, met = lines._unmet(met, names)
        assert new.tolist() == [int(x) not in seen for x in names]
        seen |= set(names.tolist())
        assert met.tolist() == sorted(seen) and met.nbytes == 8 * len(seen)
    made = list(lines._segmented(iter([pa.record_batch([pa.array(["a line of over twenty characters\nshort"] * 9)], ["text"])] * 2)))
    assert sum(x.num_rows for x in made) == made[0].num_rows > 0


def test_other_work_starts_without_what_a_worker_kept():
    import pyarrow as pa

    from gaugeworks.llm import store, toxicity

    for work in (toxicity._found, jaccard._sets, lines._lines):
        store.kept["a tokenizer"] = object()
        next(iter(work(pa.array(["some words of a text"] * 3))))
        assert not store.kept
