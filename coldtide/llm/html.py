"""Main text of web pages with per-host removal of template subtrees.

Markup is read by one regular expression into a tree with an explicit stack.
The corpus step hashes the element subtrees of whole pages, menus and footers
included, counts in Spark on how many distinct pages of their host each stands,
and deletes those that recur on many: on ``min_share`` of the host's pages and
on ``min_pages`` of them, or on all if the host has fewer, but on three at
least. Containers (``div``, ``section``, ``ul`` and the like) go from the far
lower ``rare_share`` on, for hosts of many layouts, if they stand on
``min_pages``; but where they are more than half of a page's blocks and of its
text they stay: that page is a near copy of others. Paragraphs, headings and
parts of a sentence, list or table need the higher share, since articles quote
the same passages. A host's lists are filtered by these shares before
they are gathered, so they are bounded by the subtrees of a page over the lower
share.

Elements that never hold an article (by tag, role, or class and id words) go as
well, on any host; what is left is the article or main element, if the page has
one, else the body.

Defined cases: null or empty html gives an empty text; pages whose texts are
equal after the cuts count once, whatever their adverts and menus (copies are
not a template), and a page that would lose all of its text keeps it whole;
null URLs are one host; a tag,
comment, script or style that the end of the page cuts off ends there; ids
repeat or are null freely; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coldtide.session import ship_code, staged

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
CUT = frozenset("head nav header footer aside form script style noscript iframe template svg canvas button select textarea option audio video dialog menu title fieldset label input datalist map xmp noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr math mfrac mi mn mo mover mroot mrow ms mspace msqrt mstyle msub msubsup msup mtext munder munderover semantics".split())
#: Opening one of these ends an open element of the group, up to its scope.
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "tbody": ("tr", "td", "th", "thead", "tbody"), "thead": ("tr", "td", "th", "tbody")}
SCOPE = frozenset("html body table ul ol dl article main section div td th".split())
#: Words of class, id or role that mark what is not the article.
MARKS = frozenset("ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion menu nav navbar navigation breadcrumb breadcrumbs footer masthead sidebar aside widget cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe signup login share sharing social related recommended comment comments disqus respond reply replies pagination pager contentinfo complementary search toolbar".split())
NEGATIVE = frozenset("no not has with without non".split())
KEEP = frozenset("html body main".split())
#: What does not end a head that is open.
IN_HEAD = frozenset("html head title base link meta style script noscript template".split())
#: Besides inline elements, what recurs in articles by itself: equal words and
#: cells say little, and articles quote passages and share headings.
PARTS = INLINE | frozenset("li dt dd tr td th p h1 h2 h3 h4 h5 h6 blockquote pre figcaption".split())


class Node:
    __slots__ = ("cut", "parts", "tag")

    def __init__(self, tag: str, cut: bool = False):
        self.tag = tag
        #: Whether tag or attributes say that this is not the article.
        self.cut = cut
        self.parts: list[Node | str] = []


def marked(tag: str, attributes: str) -> bool:
    """Whether class, id, role or hiding say that this is not the article."""
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        if name == "style":
            if re.search(r"display\s*:\s*none", value, re.I):
                return True
            continue
        words = [w.lower() for w in WORD.findall(value)]
        if any(w in MARKS and not (i and words[i - 1] in NEGATIVE) for i, w in enumerate(words)):
            return True
    return False


def tree(html: str) -> Node:
    """The page's elements with their texts."""
    root = Node("html")
    open_: list[Node] = [root]
    number: dict[str, int] = {}  # of open elements by tag, so that no walk is in vain

    def close(k: int) -> None:
        for node in open_[k:]:
            number[node.tag] -= 1
        del open_[k:]

    at, end = 0, len(html)
    while at < end:
        found = TOKEN.search(html, at)
        stop = found.start() if found else end
        if stop > at:
            open_[-1].parts.append(html[at:stop])
        if not found:
            break
        at = found.end()
        if not found[2]:
            continue
        if not found[4]:
            break
        tag = found[2].lower()
        if found[1]:
            if tag == "br":
                open_[-1].parts.append(" ")
            elif number.get(tag):
                for k in range(len(open_) - 1, 0, -1):
                    if open_[k].tag == tag:
                        close(k)
                        break
                    if tag in INLINE and open_[k].tag not in INLINE:
                        break
            continue
        if number.get("head") and open_[-1].tag == "head" and tag not in IN_HEAD:
            close(len(open_) - 1)
        if tag in VOID or tag in ("html", "body"):
            if tag == "br":
                open_[-1].parts.append(" ")
            elif tag == "hr":
                open_[-1].parts.append(Node("hr"))
            continue
        group = ENDS.get(tag, ("p",) if tag in ENDS_P else ())
        if any(number.get(x) for x in group):
            for k in range(len(open_) - 1, 0, -1):
                if open_[k].tag in group:
                    close(k)
                    break
                if open_[k].tag in SCOPE:
                    break
        if tag in RAW:
            closing = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(html, at)
            if not closing:
                break
            at = closing.start()
        node = Node(tag, tag in CUT or bool(found[3].strip()) and tag not in KEEP and marked(tag, found[3]))
        open_[-1].parts.append(node)
        if not found[3].endswith("/") or tag not in ("svg", "path"):
            open_.append(node)
            number[tag] = number.get(tag, 0) + 1
    return root


def content(root: Node) -> list[Node]:
    """Outermost main or article elements that hold text, else the root."""
    found, todo = [], [root]
    while todo:
        node = todo.pop()
        if node.tag in ("article", "main"):
            found.append(node)
        else:
            todo += [x for x in reversed(node.parts) if isinstance(x, Node) and not x.cut]
    held = [x for x in found if any(blocks([x], frozenset()))]
    return held or [root]


def blocks(nodes: list[Node], template: frozenset[int], known: dict[int, int] | None = None) -> list[str]:
    """Texts of the blocks in page order, without what is cut and without the
    template subtrees by ``known`` hashes."""
    out: list[str] = []
    run: list[str] = []

    def close() -> None:
        text = " ".join(unescape("".join(run)).split())
        if text:
            out.append(text)
        run.clear()

    known = known or {}
    for top in nodes:
        todo: list[Node | str | None] = [top]
        while todo:
            part = todo.pop()
            if part is None:
                close()
            elif isinstance(part, str):
                run.append(part)
            elif part.cut or template and known.get(id(part)) in template:
                if part.tag not in INLINE:
                    close()
            else:
                if part.tag not in INLINE:
                    close()
                    todo.append(None)
                todo += reversed(part.parts)
        close()
    return out


def hashes(root: Node) -> dict[int, int]:
    """Signed 64-bit hash of every subtree that holds text, by node identity.

    The lowest bit says whether the subtree is one of PARTS.
    """
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += [x for x in node.parts if isinstance(x, Node)]
    found: dict[int, int] = {}
    for node in reversed(order):
        inner = [str(found.get(id(x), "")) if isinstance(x, Node) else " ".join(x.split()) for x in node.parts]
        if any(inner):
            value = xxhash.xxh3_64_intdigest("\x00".join([node.tag, *inner])) & ~1 | (node.tag in PARTS)
            found[id(node)] = value - (1 << 64) if value >> 63 else value
    found.pop(id(root), None)
    return found


def host_key(url: Column) -> Column:
    """The URL's host in lower case; null and hostless URLs are one host."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")))


def templates(pages: DataFrame, url_col: str = "url", html_col: str = "html", min_pages: int = 20, min_share: float = 0.5, rare_share: float = 0.01) -> DataFrame:
    """Per host the sorted lists of subtree hashes that make up its template:
    those on ``min_share`` of its pages, and the other blocks on ``rare_share``."""
    ship_code(pages.sparkSession)

    def subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, keys, page = [], [], []
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                root = tree(html or "")
                # Copies of an article under other adverts or menus are one page.
                own = xxhash.xxh3_64_intdigest("\n\n".join(blocks(content(root), frozenset()))) >> 1
                found = {0, *hashes(root).values()}
                hosts += [host] * len(found)
                keys += found
                page += [own] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(keys, pa.int64()), pa.array(page, pa.int64())], ["_host", "_key", "_page"])

    rows = pages.select(host_key(pages[url_col]).alias("_host"), pages[html_col].alias("_html")).mapInArrow(subtrees, "_host string, _key long, _page long")
    counts = rows.distinct().groupBy("_host", "_key").agg(F.count("*").alias("_n")).where("_key = 0 or _n >= 3")
    counts = staged(counts, "subtree-counts")
    # Key 0 stands on every page, so its count is the host's number of pages.
    totals = counts.where("_key = 0").select("_host", F.col("_n").alias("_pages"))
    counts = counts.where("_key <> 0").join(totals, "_host")
    many = F.col("_n") >= F.least(F.lit(min_pages), F.col("_pages"))
    common = many & (F.col("_n") >= min_share * F.col("_pages"))
    rare = many & (F.col("_n") >= min_pages) & (F.col("_key").bitwiseAND(1) == 0) & (F.col("_n") >= rare_share * F.col("_pages"))
    listed = counts.where(common | rare).groupBy("_host")
    return listed.agg(F.sort_array(F.collect_list(F.when(common, F.col("_key")))).alias("_template"), F.sort_array(F.collect_list(F.when(~common, F.col("_key")))).alias("_rare"))


def without(root: Node, common: frozenset[int], rare: frozenset[int]) -> list[str]:
    """Blocks of a page without its host's template, but never none of its blocks."""
    nodes, known = content(root), hashes(root) if common or rare else {}
    known = {k: v for k, v in known.items() if v in common or v in rare}
    for node in nodes:
        known.pop(id(node), None)
    if not known:
        return blocks(nodes, frozenset())
    kept = blocks(nodes, common, known) or blocks(nodes, frozenset())
    if rare and kept:
        left = blocks(nodes, common | rare, known)
        if left and (2 * len(left) >= len(kept) or 2 * sum(map(len, left)) >= sum(map(len, kept))):
            return left
    return kept


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_pages: int = 20, min_share: float = 0.5, broadcast_bytes: int = 1 << 25, rare_share: float = 0.01) -> DataFrame:
    """Id, url, text and n_chars of every page.

    The template lists are staged; they are broadcast only if hosts and hashes
    are no more than ``broadcast_bytes``, and joined by host otherwise (adaptive
    execution splits a hot host).
    """
    lists = staged(templates(pages, url_col, html_col, min_pages, min_share, rare_share), "templates")
    size = F.sum(F.octet_length("_host") + 64 + 8 * (F.size("_template") + F.size("_rare")))
    if (lists.agg(size).first()[0] or 0) <= broadcast_bytes:
        lists = F.broadcast(lists)
    kinds = [pages.schema[c].dataType.simpleString() for c in (id_col, url_col)]

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for html, common, rare in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4))):
                texts.append("\n\n".join(without(tree(html or ""), frozenset(common or ()), frozenset(rare or ()))))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], ["id", "url", "text", "n_chars"])

    rows = pages.select(pages[id_col].alias("id"), pages[url_col].alias("url"), pages[html_col].alias("html"), host_key(pages[url_col]).alias("_host"))
    rows = rows.join(lists, "_host", "left").select("id", "url", "html", "_template", "_rare")
    out = rows.mapInArrow(extract, f"id {kinds[0]}, url {kinds[1]}, text string, n_chars long")
    return out.withColumnsRenamed({"id": id_col}) if url_col == "url" else out.withColumnsRenamed({"id": id_col, "url": url_col})


def op8(spark, sf_dir: str) -> DataFrame:
    return main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
