"""Main text of web pages: elements that recur on a host's pages are its template.

Every page is parsed once; the hashes of its element subtrees are counted per host, subtrees that
recur on many pages of the host are deleted, and the main text is read from what is left.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections import Counter

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import materialize
from tidegate.operators.keys import unique_lookup

MIN_PAGES = 10  # pages of a host on which a subtree recurs at least
MIN_SHARE = 0.05  # of the host's pages
FEW_PAGES = 3  # so few are enough where they are this share of the host's pages
FEW_SHARE = 0.5

_NOTE = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?", re.S)
_TAG = re.compile(r"</?[a-zA-Z][^\s/>]*+(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_SPACE = re.compile(r"\s+")
# Kinds of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg object select button canvas".split())
OPAQUE = frozenset("script style textarea title iframe".split())
HIDDEN = frozenset("script style template noscript".split())  # part of no block
INLINE = frozenset(
    "a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr math mi mo mn ms mtext mrow msup msub msubsup mfrac msqrt mroot mstyle "
    "semantics annotation".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre table tbody thead tr td th figure figcaption".split())
APART = frozenset("nav header footer aside form dialog menu fieldset".split())
MAIN = frozenset(("article", "main"))
# Whole class and id words.
_APART_WORDS = frozenset(
    "ad ads advert advertisement banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs "
    "header site-header page-header footer site-footer page-footer sidebar side-bar comments comment-list comment-form respond "
    "disqus disqus_thread notice cookie cookies cookie-notice cookie-banner consent newsletter subscribe subscription share "
    "sharing social social-links related related-posts popup modal widget login signup".split())
_APART_ROLE = frozenset("navigation banner contentinfo complementary search form dialog alert menu".split())
CLOSES_P = PROSE - {"li", "tr", "td", "th", "tbody", "thead", "dt", "dd", "figcaption"} | MAIN | APART | {"div", "section", "hr"}
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "dt": {"dl"}, "dd": {"dl"}}


class Node:
    """``apart`` elements are never main text; those with a ``cue`` in their names are not unless they hold most of it."""

    __slots__ = ("apart", "children", "cue", "label", "tag")

    def __init__(self, tag: str, label: str = "", apart: bool = False, cue: bool = False):
        self.tag, self.label, self.apart, self.cue, self.children = tag, label, apart, cue, []


def parse(page: str) -> Node:
    """A tree of elements and decoded texts; unclosed and stray tags are borne.

    Every character is looked at a bounded number of times.  A tag ends at the first > outside quotes; from the
    first tag on whose quotes never end, at the first >.
    """
    root = Node("#page")
    stack = [root]
    opened: Counter[str] = Counter()
    at, size, quotes = 0, len(page), True

    def close(i: int) -> None:
        opened.subtract(n.tag for n in stack[i:])
        del stack[i:]

    def close_to(tags: set[str] | frozenset[str], stop) -> None:
        """Close the innermost of these elements, unless an element that stops the search is further in."""
        if not any(opened[t] for t in tags):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                close(i)
                return
            if stop(stack[i].tag):
                return

    while at < size:
        if page[at] != "<":
            end = page.find("<", at)
            end = size if end < 0 else end
            stack[-1].children.append(html.unescape(page[at:end]))
            at = end
            continue
        if note := _NOTE.match(page, at):
            at = note.end()
            continue
        name = _NAME.match(page, at)
        if not name:
            stack[-1].children.append("<")
            at += 1
            continue
        found = _TAG.match(page, at) if quotes else None
        if found:
            token = found[0]
        else:
            quotes = False
            end = page.find(">", at)
            if end < 0:  # no tag ends from here on
                stack[-1].children.append(html.unescape(page[at:]))
                break
            token = page[at:end + 1]
        at += len(token)
        tag = name[1].lower()
        if token[1] == "/":
            close_to({tag}, lambda t, inline=tag in INLINE: inline and t not in INLINE)
            continue
        if tag in CLOSES_P:
            close_to({"p"}, lambda t: t not in INLINE)
        if tag in CLOSED_BY:
            close_to(CLOSED_BY[tag], lambda t, scopes=SCOPES.get(tag, ()): t in scopes)
        marks = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(token)} if "=" in token else {}
        apart = tag in RAW or tag in APART and not (tag == "header" and any(opened[t] for t in MAIN))
        words = f"{marks.get('class', '')} {marks.get('id', '')}".lower().split()
        cue = tag not in MAIN and tag not in ("body", "html") and (
            marks.get("role", "").lower() in _APART_ROLE or not _APART_WORDS.isdisjoint(words))
        node = Node(tag, marks.get("class", ""), apart, cue)
        stack[-1].children.append(node)
        if tag in OPAQUE:
            end = re.compile(rf"</{tag}[\s/>]", re.I).search(page, at)
            at = end.start() if end else size
        elif tag not in VOID and not token.endswith("/>"):
            stack.append(node)
            opened[tag] += 1
    return root


def _digest(*parts: str | int) -> int:
    return int.from_bytes(hashlib.blake2b("\0".join(map(str, parts)).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def _post_order(root: Node) -> list[Node]:
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(c for c in node.children if isinstance(c, Node))
    return order[::-1]


def outline(page: str) -> tuple[list[int], list[int], list]:
    """(hashes of subtrees that hold text, number of the one around each or -1, blocks).

    A block is [text, number of the hashed subtree around it or -1, 1 within an article or main element].
    Hashes of articles and of prose within them are odd, all others even: a passage that several articles share
    may be theirs, not the template's.
    """
    root = parse(page)
    hashes: dict[int, int] = {}
    held: dict[int, int] = {}  # characters of text outside elements that are apart
    whole: dict[int, bool] = {}  # whether there is any text
    for node in _post_order(root):
        parts = [_SPACE.sub(" ", c) if isinstance(c, str) else hashes[id(c)] for c in node.children]
        hashes[id(node)] = _digest(node.tag, node.label, *parts)
        whole[id(node)] = any(isinstance(c, str) and not c.isspace() or isinstance(c, Node) and whole[id(c)] for c in node.children)
        held[id(node)] = 0 if node.apart else sum(
            len(c.strip()) if isinstance(c, str) else held[id(c)] for c in node.children)
    subtrees: list[int] = []
    parents: list[int] = []
    blocks: list = []
    text: list[str] = []
    around: list[tuple[int, int]] = [(-1, 0)]
    total = held[id(root)]

    def flush() -> None:
        if words := " ".join("".join(text).split()):
            blocks.append([words, *around[-1]])
        text.clear()

    todo: list = [(root, True)]
    while todo:
        node, entering = todo.pop()
        if isinstance(node, str):
            text.append(node)
        elif not entering:
            flush()
            around.pop()
        elif node.tag in HIDDEN:
            continue
        elif node.tag in ("br", "wbr", "img"):
            text.append(" ")
        else:
            apart = node.apart or node.cue and 2 * held[id(node)] <= total
            if node.tag in INLINE and not apart:
                todo.extend((c, True) for c in reversed(node.children))
                continue
            flush()
            own, main = around[-1]
            inside = main or int(node.tag in MAIN)
            if whole[id(node)] and node.tag not in ("#page", "html", "body"):
                parents.append(own)
                own = len(subtrees)
                subtrees.append(hashes[id(node)] & ~1 | int(bool(inside and (node.tag in PROSE or node.tag in MAIN))))
            if not apart:
                around.append((own, inside))
                todo.append((node, False))
                todo.extend((c, True) for c in reversed(node.children))
    flush()
    return subtrees, parents, blocks


def main_text(subtrees: list[int], parents: list[int], blocks: list, gone: set[int]) -> str:
    """Blocks outside deleted subtrees, those of the article where it holds most of their text."""
    lost: list[bool] = []
    for subtree, parent in zip(subtrees, parents, strict=True):  # what is around comes first
        lost.append(subtree in gone or parent >= 0 and lost[parent])
    left = [b for b in blocks if b[1] < 0 or not lost[b[1]]]
    inside = [b for b in left if b[2]]
    if 2 * sum(len(b[0]) for b in inside) > sum(len(b[0]) for b in left):
        left = inside
    return "\n".join(b[0] for b in left)


def _outlines(batches):
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        found = [outline(h) for h in batch["html"]]
        yield pd.DataFrame({
            "page": batch["page"], "url": batch["url"],
            "host": [re.sub(r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/@?#]*@)?", "", u or "", flags=re.I).split("/")[0].split("?")[0].split("#")[0].split(":")[0].lower() for u in batch["url"]],
            "digest": [_digest(h) for h in batch["html"]],
            "subtrees": [s for s, _, _ in found],
            "packed": [pack(json.dumps(rest, ensure_ascii=False).encode("utf-8", "surrogatepass")) for _, *rest in found],
        })


def _texts(batches):
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        texts = []
        for subtrees, packed, gone in zip(batch["subtrees"], batch["packed"], batch["gone"], strict=True):
            parents, blocks = json.loads(unpack(bytes(packed)).decode("utf-8", "surrogatepass"))
            lost = set() if gone is None else set(np.asarray(gone).tolist())
            texts.append(main_text(np.asarray(subtrees).tolist(), parents, blocks, lost))
        yield pd.DataFrame({"page": batch["page"], "url": batch["url"], "text": texts})


def extract(
    df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE,
) -> DataFrame:
    """The main text of whole pages.

    A subtree is deleted when it is on at least ``min_pages`` pages and ``min_share`` of the pages of its
    host, or on ``FEW_PAGES`` pages and ``FEW_SHARE`` of them; an article or prose within one only
    in the second case.  Pages equal in host and html count as one page.  Menus, footers, forms, scripts, headers
    outside articles and the like are left out by their element as well, and what counts leave open by whole
    words of class or id and by role, but never an element that holds most of the page's text.
    Where article and main elements hold more than half of the text then left, only theirs is taken.
    Blocks are in page order, one line each, with character references decoded and white space
    made single spaces.

    Returns id, url, text and n_chars, one row for each input row.  A null or empty page has the text
    '' and 0.  Pages with a null url are one host.  Null and repeated ids stay as they are.
    """
    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(
        F.col(id_col).alias("page"), F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    parsed = rows.mapInPandas(
        _outlines, f"page {kind}, url string, host string, digest long, subtrees array<long>, packed binary")
    parsed = materialize(parsed.withColumn("row", F.monotonically_increasing_id()), "pages")
    rows_of = parsed.groupBy("host").agg(F.count(F.lit(1)).alias("n"))
    different = parsed.groupBy("host", "digest").agg(F.min("row").alias("row"))
    pages = different.groupBy("host").agg(F.count("*").alias("pages"))
    # Counted per host with partial sums over one page of each content: subtrees that recur.
    counted = parsed.select("row", "host", "subtrees").join(different.select("row"), "row", "left_semi").select(
        "host", F.explode(F.array_distinct("subtrees")).alias("subtree"))
    recurring = counted.groupBy("host", "subtree").agg(F.count("*").alias("n")).where(F.col("n") >= min(min_pages, FEW_PAGES))
    often = (F.col("n") >= min_pages) & (F.col("n") >= F.col("pages") * min_share)
    mostly = (F.col("n") >= FEW_PAGES) & (F.col("n") >= F.col("pages") * FEW_SHARE)
    of_article = F.col("subtree").bitwiseAND(F.lit(1)) == 1
    recurring = recurring.join(pages, "host").where(mostly | often & ~of_article)
    # At most 1 / share times the subtrees of one page recur on a host; the pages themselves stay where they are.
    hosts = materialize(recurring.groupBy("host").agg(F.collect_list("subtree").alias("lost")), "hosts")
    whole = unique_lookup(parsed, hosts, ["host"], frequency=rows_of).select(
        "page", "url", "subtrees", "packed", F.array_intersect("subtrees", "lost").alias("gone"))
    return whole.mapInPandas(_texts, f"page {kind}, url string, text string").select(
        F.col("page").alias(id_col), F.col("url").alias(url_col), "text", F.length("text").cast("long").alias("n_chars"))
