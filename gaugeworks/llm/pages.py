"""Main text of web pages: site templates found by counting element subtrees per host.

Every element gets a hash of its subtree. A subtree that stands in many unlike pages
of a host (inside a marked article: in many unlike articles) belongs to the site's
template and is deleted. What is left loses what names itself a menu, header, footer,
sidebar, notice, advert, form or comment, and what stands outside marked articles.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.store import written

#: A subtree is a template where it stands on so many pages of its host, and this share of them; copies count once.
LEAST_PAGES, LEAST_SHARE = 5, 0.02
FILTER_BITS = 1 << 23

# Elements by what they do to the text around or inside them.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset(
    "nav footer aside form button select datalist dialog menu search object canvas audio video map head label "
    "fieldset output progress meter".split())
MAIN = frozenset(("article", "main"))
#: Inside an article these go with their list or table, not alone: a cell or item is alike by chance.
PARTS = frozenset("caption dd dt figcaption legend li optgroup option summary tbody td tfoot th thead tr".split())
#: An opening tag ends these open elements.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",), "tbody": ("thead", "tbody", "tr", "td", "th"),
    "tfoot": ("thead", "tbody", "tr", "td", "th")}
ENDS_P = BLOCKS - frozenset("caption dd dt legend li option optgroup summary tbody td tfoot th thead tr body html".split())
#: Ends of the reach of those rules.
SCOPE = frozenset("ul ol dl table select article main section div body html nav aside".split())
NAMED = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent "
    "gdpr notice notices alert popup modal overlay newsletter subscribe subscription sidebar menu nav navbar "
    "navigation breadcrumb breadcrumbs pagination pager footer comment comments disqus replies share sharing social "
    "related recommended widget toolbar masthead skip login search".split())
#: With a named word first these still name the same part, as in comment-list or menu-item.
FITTINGS = frozenset(
    "area articles author bar bars block body bottom box button buttons column container content count entry footer form "
    "group head header heading holder id inner input item items label left link links list main message meta module "
    "outer overlay panel popup posts region reply right row section slot stories tab text thread title toggle top trail "
    "unit view widget widgets wrap wrapper zone".split())
#: Before a named word these say something of the layout: no-sidebar, has-menu.
LAYOUT = frozenset("has hide is no not show with without".split())
#: What names itself so is an article, whatever else it is called.
STORY = frozenset("article entry hentry main post story".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog alertdialog menu menubar".split())

_ATTRIBUTES = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(script|style|textarea|title|noscript|template|svg|math|iframe|xmp)\b{_ATTRIBUTES}>.*?(?:</\1\s*>|\Z)"
    rf"|<(/?)([A-Za-z][^\s/>]*+)({_ATTRIBUTES})>"
    r"|<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>"
    r"|<[!?/][^>]*+>"
    r"|<[A-Za-z!?/][^>]*+\Z", re.S | re.I)
_NAMES = re.compile(r"""\b(class|id|role|aria-hidden|style|hidden)\b(?:\s*=\s*("[^"]*+"|'[^']*+'|[^\s>]++))?""", re.I)
_PARTS = re.compile(r"[a-z]+")


def _names(value: str, in_main: bool) -> bool:
    """Whether a class or id names what is no part of the article.

    A named word counts at the end of a name (site-footer) or before fittings alone (comment-list); in a
    name that goes on otherwise (notice-period, comment-open) it says something else.
    """
    for name in value.split():
        parts = _PARTS.findall(name)
        if not parts or parts[0] in LAYOUT:
            continue
        first, last = ({x} & NAMED or ({x} & {"header"} and not in_main) for x in (parts[0], parts[-1]))
        if last or first and all(x in FITTINGS or x in NAMED for x in parts[1:]):
            return True
    return False


def _unwanted(tag: str, attributes: str, in_main: bool) -> str:
    """"always" for what is never part of the article, "named" where only a class, an id or a form says so."""
    if tag == "form":
        return "named"
    if tag in DROPPED or (tag == "header" and not in_main):
        return "always"
    if not attributes or tag in ("html", "body"):
        return ""
    named = False
    for name, value in _NAMES.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id"):
            named |= _names(value, in_main)
            if tag in MAIN and not in_main and STORY & set(_PARTS.findall(value)):
                return ""
        elif name == "role" and value in ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
            return "always"
        elif name == "style" and "display:none" in value.replace(" ", ""):
            return "always"
    return "named" if named else ""


class Page:
    """The text of a page in pieces, and the subtree hashes of its elements."""

    def __init__(self, source: str):
        self.pieces: list[tuple[int, int, str]] = []  # block, element, text
        self.block = 0
        # Of each element, the page itself first: parent, subtree hash, outermost article or main around it or 0,
        # how it names itself no article, whether it may be a template.
        self.parent, self.hash, self.article, self.unwanted, self.judged = [-1], [0], [0], [""], [False]
        # Of each open element: tag, number, its subtree's parts.
        self.open: list[tuple[str, int, list[str]]] = [("", 0, [])]
        at = 0
        for token in _TOKEN.finditer(source):
            if token.start() > at:
                self._add(source[at:token.start()])
            at = token.end()
            slash, tag, attributes = token.group(2, 3, 4) if token.group(3) else token.group(5, 6, 7)
            if tag:
                tag = tag.lower()
                if slash:
                    self._end(tag)
                else:
                    self._begin(tag, attributes)
        if at < len(source):
            self._add(source[at:])
        while len(self.open) > 1:
            self._close()
        self._hash(*self.open[0])

    def _add(self, piece: str) -> None:
        _, number, parts = self.open[-1]
        if "&" in piece:
            piece = entities.unescape(piece)
        self.pieces.append((self.block, number, piece))
        parts.append(piece.strip())

    def _flush(self) -> None:
        self.block += 1

    def _hash(self, tag: str, number: int, parts: list[str]) -> None:
        if any(parts):
            self.hash[number] = xxhash.xxh64_intdigest(f"{tag}\1" + "\2".join(parts)) >> 1

    def _close(self) -> None:
        tag, number, parts = self.open.pop()
        if tag in BLOCKS:
            self._flush()
        self._hash(tag, number, parts)
        if self.hash[number]:
            self.open[-1][2].append(str(self.hash[number]))

    def _close_to(self, tags: tuple[str, ...], scope: frozenset) -> None:
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k][0] in tags:
                while len(self.open) > k:
                    self._close()
                return
            if self.open[k][0] in scope:
                return

    def _begin(self, tag: str, attributes: str) -> None:
        if tag in ENDS_P:
            self._close_to(("p",), SCOPE)
        if tag in CLOSES:
            self._close_to(CLOSES[tag], SCOPE)
        if tag in BLOCKS:
            self._flush()
        if tag in VOID:
            if tag == "br":
                self._add(" ")
            return
        parent, number = self.open[-1][1], len(self.parent)
        inside = self.article[parent]
        self.parent.append(parent)
        self.hash.append(0)
        self.article.append(inside or (number if tag in MAIN else 0))
        self.unwanted.append(_unwanted(tag, attributes, inside > 0))
        self.judged.append(tag in BLOCKS and tag not in ("html", "body") and not (inside and tag in PARTS))
        self.open.append((tag, number, []))

    def _end(self, tag: str) -> None:
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k][0] == tag:
                while len(self.open) > k:
                    self._close()
                return
        if tag in BLOCKS:
            self._flush()

    def subtrees(self) -> set[tuple[int, int]]:
        """(subtree, what it is counted once in: its article, outside of one the page); the page itself is subtree 0."""
        return {(0, self.hash[0])} | {(h, self.hash[self.article[k]]) for k, h in enumerate(self.hash) if h and self.judged[k]}

    def deleted(self, templates: frozenset[int]) -> list[bool]:
        """Of each piece, whether a template holds it.

        An article of which templates are more than half is a copy of others; none of it goes.
        """
        gone = [False] * len(self.parent)
        for k in range(1, len(self.parent)):  # a parent comes before its children
            gone[k] = gone[self.parent[k]] or self.judged[k] and self.hash[k] in templates
        held, lost = [0] * len(gone), [0] * len(gone)
        for _, k, text in self.pieces:
            size = len(text.strip())
            held[self.article[k]] += size
            lost[self.article[k]] += size * gone[k]
        return [gone[k] and not (self.article[k] and 2 * lost[self.article[k]] > held[self.article[k]])
                for _, k, _ in self.pieces]

    def main_text(self, templates: frozenset[int] = frozenset()) -> str:
        """The blocks no template holds, without what is no article; inside marked articles only, where one has text.

        What only a class, an id or a form calls no article stays where all marked articles lie in such parts and
        it holds one. Sizes decide nothing: a page of a menu alone, or with an empty article, has the empty text.
        Where all that is left is templates the page is a copy and keeps them.
        """
        pieces = self.pieces
        if templates:
            pieces = [x for x, gone in zip(pieces, self.deleted(templates)) if not gone]
        inside = [False] * len(self.parent)  # of something unwanted
        for k in range(1, len(inside)):
            inside[k] = inside[self.parent[k]] or bool(self.unwanted[k])
        spared = [False] * len(inside)
        if all(inside[k] for k in range(1, len(inside)) if self.article[k] == k):
            # From the last element up: whether a marked article that is wanted itself lies inside.
            for k in range(len(spared) - 1, 0, -1):
                holds = spared[k] and self.unwanted[k] != "always" or self.article[k] == k and not self.unwanted[k]
                spared[self.parent[k]] |= holds
        gone = [False] * len(self.parent)
        for k in range(1, len(gone)):
            gone[k] = gone[self.parent[k]] or bool(self.unwanted[k]) and not (self.unwanted[k] == "named" and spared[k])
        pieces = [x for x in pieces if not gone[x[1]]]
        if any(self.article[k] == k and not gone[k] for k in range(1, len(gone))):
            pieces = [x for x in pieces if self.article[x[1]]]
        blocks: dict[int, list[str]] = {}
        for block, _, text in pieces:
            blocks.setdefault(block, []).append(text)
        out = "\n".join(filter(None, (" ".join("".join(x).split()) for x in blocks.values())))
        return out if out or not templates else self.main_text()


HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)"


def templates(df: DataFrame) -> DataFrame:
    """(row, subtree) of the template subtrees that stand on a row of `df` (row, host, html)."""
    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, host, subtree, unit = [], [], [], []
            for r, h, source in zip(*(batch.column(k).to_pylist() for k in range(3))):
                found = Page(source or "").subtrees()
                row += [r] * len(found)
                host += [h] * len(found)
                subtree += [x for x, _ in found]
                unit += [x for _, x in found]
            yield pa.record_batch([pa.array(x, pa.int64()) for x in (row, host, subtree, unit)],
                                  ["row", "host", "subtree", "unit"])
    # A page without a host belongs to no site.
    named = df.filter("host IS NOT NULL").select("row", F.xxhash64("host").alias("host"), "html")
    on_page = written(named.mapInArrow(listed, "row long, host long, subtree long, unit long"), "subtrees")
    counts = written(on_page.groupBy("host", "subtree").agg(F.count_distinct("unit").alias("n"))
                     .filter((F.col("subtree") == 0) | (F.col("n") >= LEAST_PAGES)), "counts")
    pages = counts.filter("subtree = 0").select("host", F.col("n").alias("pages"))
    many = (counts.filter("subtree <> 0").join(pages, "host").filter(F.col("n") >= LEAST_SHARE * F.col("pages"))
            .select("host", "subtree"))
    return on_page.join(written(many, "templates"), ["host", "subtree"], "left_semi").select("row", "subtree")


def extracted(df: DataFrame, html: str = "html", url: str = "url", key: str = "page_id") -> DataFrame:
    """page_id, url, text and n_chars of each row of `df`, whose rows are read alike each time, as files are.

    Each page loses the templates of its host, then what `Page.main_text` takes for
    no article. A null, empty or broken page has what text it has, at least the empty
    one. Null and odd addresses have no host and no template. Ids may be null or repeated.
    """
    placed = df.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.col(url).alias("address"),
                       F.lower(F.nullif(F.regexp_extract(F.col(url), HOST, 1), F.lit(""))).alias("host"),
                       F.col(html).alias("html"))
    gone = written(templates(placed).groupBy("row").agg(F.collect_set("subtree").alias("gone")), "gone")
    # A filter of fixed size keeps most pages without a template from being moved.
    place = F.xxhash64("row").bitwiseAND(F.lit(FILTER_BITS - 1))
    words = gone.select(place.alias("x")).groupBy(F.expr("x div 64").alias("k")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(x % 64 as int))")).alias("m")).toArrow()
    held = np.zeros(FILTER_BITS // 64, np.int64)
    held[words["k"].to_numpy()] = words["m"].to_numpy()
    bits = held.view(np.uint8)

    @F.arrow_udf("boolean")
    def met(place: pa.Array) -> pa.Array:
        at = place.to_numpy(zero_copy_only=False)
        return pa.array((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0)

    @F.arrow_udf("string")
    def plain(source: pa.Array) -> pa.Array:
        return pa.array([Page(x.as_py() or "").main_text() for x in source], pa.string())

    @F.arrow_udf("string")
    def stripped(source: pa.Array, gone: pa.Array) -> pa.Array:
        return pa.array([Page(x.as_py() or "").main_text(frozenset(g.as_py() or ())) for x, g in zip(source, gone)],
                        pa.string())
    one = placed.filter(~met(place)).withColumn("text", plain("html"))
    other = placed.filter(met(place)).join(gone, "row", "left").withColumn("text", stripped("html", "gone"))
    both = one.select("key", "address", "text").union(other.select("key", "address", "text"))
    return both.select(F.col("key").alias(key), F.col("address").alias(url), "text",
                       F.length("text").cast("long").alias("n_chars"))
