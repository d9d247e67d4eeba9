"""Mixing, quality, toxicity, pieces, token counts, language scores and pages."""

import math
import random
import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F

from gaugeworks.llm import language, mixing, pages, pieces, quality, tokencount, toxicity
from gaugeworks.llm.words import row_words

from .conftest import WORD, prose, words

SP, BPE = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")


def test_word_hashes_of_long_and_odd_texts():
    texts = ["a b", None, "", "x" * 3_000_000 + " y", "A\tb\x0bc\x1cd", "word " * 400_000]
    got = []
    for _, _, w in row_words(pa.array(texts)):
        got += [w.hashes[x:y].tolist() for x, y in zip(w.bounds[:-1], w.bounds[1:])]
    assert [len(x) for x in got] == [len(words(t)) for t in texts]
    assert got[0][0] == got[4][0] and got[0][1] == got[4][1] and len(set(got[5])) == 1


def test_mix(docs, corpus, nothing):
    got = mixing.mix(docs).collect()
    assert len(got) == len(corpus)
    assert sorted(r.asDict()["_size"] for r in got) == sorted(len(WORD.findall(r[1] or "")) for r in corpus)
    by = {}
    for r in got:
        by.setdefault(r.source, []).append(r)
        assert 0 <= r.taken <= 3 * r["_size"]
    for rows in by.values():
        assert sum(r["_size"] for r in rows) == rows[0].source_size
        assert abs(sum(r.taken for r in rows) - rows[0].target) <= 1
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs).collect()))
    assert mixing.mix(nothing).count() == 0
    out = mixing.repeated(docs)
    assert out.columns == docs.columns
    taken = sum(r.taken for r in got)
    assert sum(len(WORD.findall(r.text)) for r in out.collect()) == taken
    assert mixing.repeated(nothing).count() == 0


def test_targets_reshare_what_small_sources_cannot_give(spark):
    sizes = spark.createDataFrame([("sa", 10), ("sb", 1000), ("sc", 1000), ("n", 5)], "s string, source_size long")
    got = {r.s: r.target for r in mixing.targets(sizes).collect()}
    assert got["sa"] == 30 and got["n"] == 15 and abs(sum(got.values()) - 2015) < 1e-6
    assert abs(got["sb"] - 2 * got["sc"]) < 1e-6


def brute_repeats(text):
    w = WORD.findall(text or "")
    seen = Counter(tuple(w[k:k + 8]) for k in range(len(w) - 7))
    return len({j for k in range(len(w) - 7) if seen[tuple(w[k:k + 8])] > 1 for j in range(k, k + 8)})


def test_quality_counts(docs, corpus, nothing):
    got = sorted((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in quality.quality(docs).collect())
    want = []
    for row in corpus:
        t = row[1] or ""
        w = WORD.findall(t)
        ls = [x for x in t.split("\n") if WORD.search(x)]
        want.append((len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(ls) - len(set(ls)), brute_repeats(t)))
    assert got == sorted(want)
    assert quality.quality(nothing).count() == 0


def test_quality_drops_junk_and_keeps_the_rest(spark):
    rng = random.Random(1)
    rows = [(k, prose(rng, 80), "en", "a") for k in range(300)]
    rows += [(1000 + k, " ".join(x + "%%%" for x in prose(rng, 80).split()), "en", "a") for k in range(60)]
    got = {r.doc_id: r.kept for r in quality.quality(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all(got[k] for k in range(300)) and not any(got[1000 + k] for k in range(60))


def test_toxicity(spark, docs, nothing):
    rng = random.Random(6)
    bad = ["idiot", "moron", "scum", "trash"]
    rows, labels = [], []
    for k in range(400):
        w = prose(rng, 60).split()
        toxic = k % 4 == 0
        for _ in range(rng.randint(1, 6) * toxic):
            w.insert(rng.randrange(len(w)), rng.choice(bad))
        rows.append((k, " ".join(w), "x"))
        if k < 240:
            labels.append((k, int(toxic)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic string")
    labelled = spark.createDataFrame(labels + [(1, None), (None, 1)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(df, labelled).collect()}
    assert all(r.toxic == "x" for r in got.values())
    held = [k for k in range(240, 400)]
    assert sum(got[k]["_toxic"] == (k % 4 == 0) for k in held) >= 0.97 * len(held)
    assert all(0 <= r.severity <= 3 and 0 <= r.p_toxic <= 1 for r in got.values())
    odd = toxicity.toxicity(docs, labelled.limit(0)).collect()
    assert len(odd) == docs.count() and not any(r.toxic for r in odd)
    assert toxicity.toxicity(nothing, labelled).count() == 0


def test_ordinal_thresholds_rise_and_weights_rank():
    rng = np.random.default_rng(0)
    x = rng.random((600, 5)) < 0.3
    grade = np.minimum(x[:, 0] * 1 + x[:, 1] * 2, 3)
    rows, cols = np.nonzero(x)
    w, t = toxicity.fit_ordinal(rows, cols, 600, 5, grade, steps=300)
    assert (np.diff(t) > 0).all() and w[1] > w[0] > max(w[2:])


def message(number, data):
    def varint(v):
        out = b""
        while v > 127:
            out += bytes([v & 127 | 128])
            v >>= 7
        return out + bytes([v])
    return varint(number << 3) + varint(data) if isinstance(data, int) else varint(number << 3 | 2) + varint(len(data)) + data


def test_pieces_agree_with_the_models_own_library(docs, nothing):
    both = pieces.both_ways(docs, SP)
    assert pieces.unlike(both, SP).count() == 0
    assert both.filter(F.col("decoded") != F.translate(F.coalesce("text", F.lit("")), "▁", " ")).count() == 0
    two = pieces.decode(pieces.encode(docs, SP), SP).select("ids", "decoded")
    assert sorted(map(str, two.collect())) == sorted(map(str, both.select("ids", "decoded").collect()))
    assert pieces.both_ways(nothing, SP).count() == 0


def test_a_unigram_model_read_field_by_field():
    import sentencepiece

    names = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("▁", -3.0, 1), ("a", -3.1, 1), ("b", -3.2, 1), ("ab", -2.0, 1), ("▁a", -2.5, 1), ("▁ab", -1.5, 1)]
    names += [(f"<0x{k:02X}>", 0.0, 6) for k in range(256)]
    data = b"".join(message(1, message(1, p.encode()) + b"\x15" + struct.pack("<f", s) + message(3, k)) for p, s, k in names)
    data += message(2, message(3, 1) + message(35, 1)) + message(3, message(3, 1) + message(4, 1))
    own, codec = sentencepiece.SentencePieceProcessor(model_proto=data), pieces.Codec(pieces.parse(data))
    for text in ["ab ab", "  a  b ", "abba é", "<s>", ""]:
        ids, size = codec.encode([text])
        assert ids.tolist() == own.encode(text) and size.tolist() == [len(ids)]


def test_token_counts(docs, corpus, nothing):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BPE)
    got = tokencount.counted(docs, BPE, 100)
    want = sorted((len((r[1] or "").encode()), n := len(library.encode(r[1] or "").ids), n > 100) for r in corpus)
    assert sorted((r.n_bytes, r.n_tokens, r.over_limit) for r in got.collect()) == want
    assert tokencount.counted(nothing, BPE, 100).count() == 0


def test_token_counts_of_random_strings():
    from tokenizers import Tokenizer

    library, mine, rng = Tokenizer.from_file(BPE), tokencount.Counter(BPE), random.Random(3)
    texts = ["".join(rng.choice("ab'strevlmd \n\t1é!<|ß中") for _ in range(rng.randint(0, 60))) for _ in range(2000)]
    texts += ["a" * 700, "=" * 300 + " ", "'s'S''ll 're've'r", "don't<|endoftext|>x", "hello" * 90]
    assert mine.of_texts(texts).tolist() == [len(e.ids) for e in library.encode_batch(texts)]


def test_language_scores(docs, corpus, nothing):
    got = language.scored(docs).collect()
    tokens = [(r[0], [*words(r[1]), None]) for r in corpus]
    out = [zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2 for i, _ in tokens]
    c = Counter(w for (_, t), o in zip(tokens, out) if not o for w in t)
    n, v = sum(c.values()), len(c)
    want = sorted((repr(i), o, len(t), sum(c[w] > 0 for w in t), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), 6))
                  for (i, t), o in zip(tokens, out))
    assert sorted((repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 for r in got)
    assert language.scored(nothing).count() == 0


def test_model_learns_and_is_normalised():
    rng = np.random.default_rng(0)
    kinds = np.tile([1, 2, 3, 4], 30_000)
    kinds[rng.random(len(kinds)) < 0.1] = 5
    frequency = np.bincount(kinds, minlength=language.CLASSES + 1).astype(float)
    trainer = language.Trainer(frequency)
    trainer.learn(kinds, np.array([0, len(kinds)]))
    context = language.contexts(kinds, np.array([0, len(kinds)]))
    logs = trainer.model.log_shares(context[:5000])
    assert np.allclose(np.exp(logs).sum(1), 1, atol=1e-4)
    share = np.log(frequency / frequency.sum(), where=frequency > 0, out=np.zeros_like(frequency))
    assert logs[np.arange(5000), kinds[:5000]].mean() > share[kinds[:5000]].mean() + 0.5


PAGE = """<!DOCTYPE html><html><head><title>t</title><script>var t="</p>";</script></head><body class="nav">
<nav><ul><li><a href="/x">menu</a></ul></nav><!-- ad --><div class="ad box">advert</div><header>site</header>
{}<form><input> send</form><aside>side</aside><div id="comments"><p>me too</div><footer>&copy; end</footer></body></html>"""


def test_main_text_of_pages():
    text = pages.Page(PAGE.format("<article><header><h1>Head &amp; more</h1></header><p>One <b>two<br>three<p>four&nbsp;five"
                                  "<div class=share>tweet</div><ul><li>six<li>seven</ul></article>")).main_text()
    assert text == "Head & more\nOne two three\nfour five\nsix\nseven"
    assert pages.Page(PAGE.format("<div><p>plain &lt;b&gt; text</p></div>")).main_text() == "plain <b> text"
    assert pages.Page("<p>cut off <b").main_text() == "cut off" and pages.Page("").main_text() == ""
    assert pages.Page("a < b & c &am &amp").main_text() == "a < b & c &am &"
    assert pages.Page("<style>x</style><p hidden>no<p>" + "yes " * 50_000).main_text() == " ".join(["yes"] * 50_000)


def test_templates_go_where_no_article_is_marked(spark, tmp_path):
    rows = [(k, f"http://a.example.com/{k}", f"<body><div>Welcome to our place</div><p>story {k} of many</p></body>") for k in range(30)]
    rows += [(40, "http://b.example.com/", "<body><div>Welcome to our place</div><p>x</p>"), (41, None, "<p>no host"),
             (42, "odd", None), (None, "http://a.example.com/", "<article>copied</article>")]
    path = str(tmp_path / "pages")
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(path)
    got = {r.page_id: (r.text, r.n_chars) for r in pages.extracted(spark.read.parquet(path)).collect()}
    assert got[3] == ("story 3 of many", 15) and got[40][0] == "Welcome to our place\nx"
    assert got[41][0] == "no host" and got[42] == ("", 0) and got[None][0] == "copied"


def test_templates_go_inside_marked_articles_too(spark, tmp_path):
    rng = random.Random(8)
    box, copied, told = "<div>Read all about our place here</div>", f"<p>{prose(rng, 30)}</p><p>{prose(rng, 30)}</p>", []
    rows = []
    for k in range(30):
        told.append(prose(rng, 40))
        rows.append((k, f"http://a.example.com/{k}", f"<nav>menu {k}</nav><article><p>{told[k]}</p>{box}<table><tr><td>0<td>{k}</table></article>"))
    # Copies and near copies of an article keep it; so does a wrapper with a telling word that holds the page.
    rows += [(100 + k, f"http://a.example.com/c{k}", f"<nav>menu {k}</nav><article>{copied}</article>") for k in range(9)]
    rows += [(200 + k, f"http://a.example.com/n{k}", f"<article>{copied}<p>note {k}</p></article>") for k in range(9)]
    rows += [(300, "http://b.example.com/", f'<nav>menu</nav><form><article class="post comment-open"><p>{told[0]}</p></article></form>')]
    path = str(tmp_path / "pages")
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(path)
    got = {r.page_id: r.text for r in pages.extracted(spark.read.parquet(path)).collect()}
    whole = copied.replace("</p><p>", "\n")[3:-4]
    assert all(got[k] == f"{told[k]}\n0\n{k}" for k in range(30))
    assert all(got[100 + k] == whole and got[200 + k] == f"{whole}\nnote {k}" for k in range(9))
    assert got[300] == told[0]


COMMENTS = "".join(f"<p>comment {k} said a lot of words here</p>" for k in range(20))
MENU = "<nav><ul>" + "".join(f"<li>entry {k}</li>" for k in range(40)) + "</ul></nav>"


def test_structure_and_not_size_decides_what_is_article():
    for body in (
            f"<article><p>Short.</p></article><div id='comments'>{COMMENTS}</div>",
            f"<article><p>Short.</p><div id='comments'>{COMMENTS}</div></article>",
            f"<article class='post'><p>Short.</p></article><div class='comments-area'><article class='comment-body'>{COMMENTS}</article></div>",
            f"{MENU}<article><p>Short.</p></article>", "<div class='comment-open'><article><p>Short.</p></article></div>",
            "<article class='post comment-open'><p>Short.</p></article>", "<div class='no-sidebar'><p>Short.</p></div>",
            "<form><div><article><p>Short.</p></article></div></form>", "<article><p class='notice-period'>Short.</p></article>",
            f"<article><p>Short.</p></article><div class='sidebar'><article>{COMMENTS}</article></div>"):
        assert pages.Page(f"<html><body>{body}</body></html>").main_text() == "Short.", body
    for body in (MENU, f"{MENU}<article></article>", "", "<footer>end</footer>"):
        assert pages.Page(body).main_text() == ""


def test_templates_are_counted_as_by_hand(spark, tmp_path):
    rng = random.Random(3)
    boxes = [f"<div><p>box {k} {prose(rng, 6)}</p></div>" for k in range(12)]
    rows = []
    for k in range(60):
        held = rng.sample(boxes[:4] if k % 2 else boxes, 2)
        rows.append((k, f"http://h{k % 2}.example/x", f"<body>{held[0]}<article><p>{prose(rng, 30)}</p></article>{held[1]}</body>"))
    rows += [(100, None, boxes[0]), (101, "http://h0.example/y", None), (60, *rows[0][1:])]
    spark.createDataFrame(rows, "row long, url string, html string").write.parquet(str(tmp_path / "pages"))
    df = spark.read.parquet(str(tmp_path / "pages")).withColumn("host", F.regexp_extract("url", pages.HOST, 1))
    got = {(r.row, r.subtree) for r in pages.templates(df.select("row", "host", "html")).collect()}
    units, held = {}, {}
    for row, url, html in rows:
        if url:
            for h, unit in pages.Page(html or "").subtrees():
                units.setdefault((url.split("/")[2], h), set()).add(unit)
                held.setdefault(row, set()).add((url.split("/")[2], h))
    many = {x for x, u in units.items() if x[1] and len(u) >= max(pages.LEAST_PAGES, pages.LEAST_SHARE * len(units[x[0], 0]))}
    assert got == {(row, x[1]) for row, hs in held.items() for x in hs & many} and got


def test_pages_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string, text string, host string")
    assert pages.extracted(empty).count() == 0
