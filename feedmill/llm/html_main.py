"""Main text of web pages, by removing what a site repeats and what pages mark as apart.

Every page is read as a tree of elements. Its subtrees, in an article or main its blocks too, are hashed bottom up,
their hashes are counted per host in Spark, once for each distinct main content, and a subtree that recurs across many
of these is deleted as part of the site's template. Menus, headers, footers, sidebars, notices, adverts, forms and reader
comments are also known by their elements, roles and class names, wherever they stand.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.llm.frames import DOC, bounded_batches, packed, staged, texts_of
from feedmill.llm.url_filter import host_of

MIN_PAGES = 5

#: Elements without content, and elements whose content is not markup.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
#: Elements that stand inside a line of text.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark math nobr output q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
#: Elements that are never part of the main text.
APART = frozenset(
    "nav footer aside form script style noscript template iframe object embed svg canvas button select textarea input dialog "
    "menu head title noembed noframes audio video map".split()
)
MAIN = frozenset(("article", "main"))
#: Elements that can be template within the main content; paragraphs, headings and quotes there are the author's.
BLOCKS = frozenset("center details div dl fieldset figure ol section table ul".split())
#: Words of class names, ids and roles that mark what is apart from the main text anywhere ...
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot sponsor sponsored promo promotion banner cookie cookies consent "
    "gdpr notice notices newsletter subscribe subscription signup login sidebar nav navbar navigation menu breadcrumb breadcrumbs "
    "comment comments disqus respond related recommended share sharing social popup modal overlay search pagination pager "
    "complementary contentinfo".split()
)
#: ... and those that do so only outside the main content, where an article may have its own.
OUTER_MARKS = frozenset("header footer masthead topbar toolbar".split())
#: Words that say where or what kind of box something is: "comment-list" marks as "comment" does, "comment-piece" does not.
BOX_WORDS = frozenset(
    "area aside bar block bottom box col column container content div global group inner item items left list main outer page "
    "panel primary right row secondary section site slot space strip tag tags text top unit widget widgets wrap wrapper zone".split()
)
#: An open paragraph, item or cell that a start tag closes, up to the nearest of the given elements.
CLOSED_BY = {
    **dict.fromkeys(
        "address article aside blockquote dir div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split(),
        ("p", frozenset()),
    ),
    "li": ("li", frozenset(("ul", "ol", "menu"))),
    "dt": ("dt dd", frozenset(("dl",))),
    "dd": ("dt dd", frozenset(("dl",))),
    "tr": ("tr td th", frozenset(("table",))),
    "td": ("td th", frozenset(("table", "tr"))),
    "th": ("td th", frozenset(("table", "tr"))),
    "option": ("option", frozenset(("select",))),
}
TAG = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>)")
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
WORD = re.compile(r"[a-z]+")
HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")


@dataclass
class Node:
    tag: str
    attributes: str
    marked: bool = False  # by a class, id or role as apart anywhere ...
    outer: bool = False  # ... or outside the main content
    inside: bool = False  # of the main content
    apart: bool = False
    parts: list = field(default_factory=list)  # texts and nodes, in page order
    hash: int = 0
    holds: bool = False  # the main content or a part of it, from outside
    size: int = 0  # of the text that is not apart


def _marks(attributes: str) -> tuple[bool, bool]:
    """Whether a class, id or role marks an element as apart, anywhere or outside the main content.

    A name counts as a whole: all its words must be marks or words of boxes, so ``has-sidebar``, ``ad-free`` or
    ``related-work`` mark nothing.
    """
    marked = outer = False
    for m in ATTRIBUTE.finditer(attributes):
        for name in (m[2] or m[3] or m[4] or "").split():
            words = set(WORD.findall(HUMP.sub(" ", name).lower()))
            own = words - BOX_WORDS
            if own and own <= MARKS:
                marked = True
            elif own and own <= MARKS | OUTER_MARKS:
                outer = True
    return marked, outer


def settle(order: list[Node]) -> None:
    """Tell what is apart and what is main content, given all nodes in page order.

    A mark never takes an element that holds an article or main element, or more than half of the page's text: there
    it says something about the page, not about the element.
    """
    whole: dict[int, int] = {}
    frames: set[int] = set()
    for node in reversed(order):  # children before parents
        size = 0
        for part in node.parts:
            if isinstance(part, str):
                size += len(part) - part.count(" ")
            elif part.tag not in APART:
                size += whole[id(part)]
                if part.tag in MAIN or id(part) in frames:
                    frames.add(id(node))
        whole[id(node)] = size
    half = whole[id(order[0])] / 2
    for node in order:
        for part in node.parts:
            if isinstance(part, str):
                continue
            free = part.tag in MAIN or id(part) in frames or whole[id(part)] > half
            part.apart = (
                node.apart
                or part.tag in APART
                or (part.tag == "header" and not node.inside)
                or (part.marked and not free)
                or (part.outer and not node.inside and not free)
            )
            part.inside = not part.apart and (node.inside or part.tag in MAIN)
    for node in reversed(order):
        for part in node.parts:
            if isinstance(part, str):
                node.size += len(" ".join(part.split()))
            else:
                node.size += 0 if part.apart else part.size
                node.holds = node.holds or part.holds or (part.inside and not node.inside)


def parse(page: str) -> Node:
    """The tree of a page; broken, unclosed and cut-off markup is read as far as it goes."""
    root = Node("", "")
    stack, order = [root], [root]
    at, end = 0, len(page)

    def text(a: int, b: int) -> None:
        if b > a:
            stack[-1].parts.append(page[a:b])

    def close(depth: int) -> None:
        for node in stack[depth:]:
            digest = xxhash.xxh64(f"{node.tag} {node.attributes}".encode("utf-8", "replace"))
            for part in node.parts:
                if isinstance(part, Node):
                    digest.update(b"\0" + part.hash.to_bytes(8, "little"))
                else:
                    digest.update(" ".join(part.split()).encode("utf-8", "replace"))
            node.hash = digest.intdigest()
        del stack[depth:]

    # Children are hashed before their parents: close() runs on the deepest first.
    def close_down(depth: int) -> None:
        while len(stack) > depth:
            close(len(stack) - 1)

    while at < end:
        start = page.find("<", at)
        if start < 0:
            text(at, end)
            break
        m = TAG.match(page, start)
        if m is None:  # a lone "<", or a tag that the page's end cuts off
            tail = re.match(r"</?[a-zA-Z!]", page[start : start + 3]) and page.find(">", start) < 0
            text(at, start if tail else start + 1)
            at = end if tail else start + 1
            continue
        text(at, start)
        if m[1]:
            stop = page.find("-->", m.end())
            at = end if stop < 0 else stop + 3
            continue
        if m[2]:
            stop = page.find(">", m.end())
            at = end if stop < 0 else stop + 1
            continue
        at, tag = m.end(), m[4].lower()
        if m[3]:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            if depth:
                close_down(depth)
            continue
        if tag in CLOSED_BY:
            closed, until = CLOSED_BY[tag]
            names = closed.split()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in names:
                    close_down(i)
                    break
                if stack[i].tag in until or (not until and stack[i].tag not in INLINE):
                    break
        parent = stack[-1]
        attributes = " ".join(m[5].split()).rstrip("/ ")
        marked, outer = _marks(attributes) if attributes and tag not in ("html", "body") else (False, False)
        node = Node(tag, attributes, marked, outer)
        parent.parts.append(node)
        order.append(node)
        if tag in RAW:
            closing = re.compile(rf"</{tag}\s*>", re.IGNORECASE).search(page, at)
            stop = closing.start() if closing else end
            node.parts.append(page[at:stop])
            at = closing.end() if closing else end
            stack.append(node)
            close_down(len(stack) - 1)
        elif tag in VOID:
            stack.append(node)
            close_down(len(stack) - 1)
        else:
            stack.append(node)
    close_down(1)
    settle(order)
    return root


def _inside_size(root: Node) -> int:
    """The size of all main content of a page."""
    total, todo = 0, [root]
    while todo:
        node = todo.pop()
        for part in node.parts:
            if isinstance(part, Node) and part.inside:
                total += part.size
            elif isinstance(part, Node) and part.holds:
                todo.append(part)
    return total


def removable(node: Node, inside_size: int) -> bool:
    """Whether a node can be template: neither the page's frame, nor what holds main content, nor most of that itself."""
    if node.holds or not node.parts or node.tag in ("", "html", "body", *MAIN):
        return False
    return not node.inside or (node.tag in BLOCKS and 2 * node.size <= inside_size)


def subtrees(root: Node) -> set[int]:
    """Hashes of the subtrees that can be template; what is apart goes anyway."""
    found, todo, inside_size = set(), [root], _inside_size(root)
    while todo:
        node = todo.pop()
        for part in node.parts:
            if isinstance(part, Node) and not part.apart:
                if removable(part, inside_size):
                    found.add(part.hash)
                todo.append(part)
    return found


def main_text(root: Node, template: frozenset[int] | set[int]) -> str:
    """The text of the blocks that are neither apart nor in ``template``, joined by one blank.

    A page with a main element gives that element's text, any other page all that is left of its body.
    """
    has_main, todo = False, [root]
    while todo and not has_main:
        node = todo.pop()
        has_main = node.inside
        todo.extend(p for p in node.parts if isinstance(p, Node) and not p.apart)
    blocks: list[str] = []
    line: list[str] = []

    def end_block() -> None:
        words = entities.unescape("".join(line)) if line else ""
        line.clear()
        if words := " ".join(words.split()):
            blocks.append(words)

    todo2: list = [root]
    inside_size = _inside_size(root) if template else 0
    while todo2:
        part = todo2.pop()
        if part is None:
            end_block()
        elif isinstance(part, str):
            line.append(part)
        elif part.apart or (part.hash in template and removable(part, inside_size)):
            if part.tag not in INLINE:
                end_block()
        else:
            block = part.tag not in INLINE
            if block:
                end_block()
                todo2.append(None)
            keep = part.inside or not has_main
            todo2.extend(p for p in reversed(part.parts) if keep or isinstance(p, Node))
    end_block()
    return " ".join(blocks)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(host, page, content, hashes)``: of a page the hash of its main text and, sorted, those of its subtrees."""
    for batch in batches:
        contents, hashes = [], []
        for page in texts_of(batch.column(2)):
            root = parse(page.decode())
            contents.append(xxhash.xxh64_intdigest(main_text(root, frozenset()).encode("utf-8", "replace")))
            hashes.append(np.sort(np.array(list(subtrees(root)), np.uint64).view(np.int64)).tolist())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array(np.array(contents, np.uint64).view(np.int64)),
                pa.array(hashes, pa.list_(pa.int64())),
            ],
            ["host", "page", "content", "hashes"],
        )


def site_templates(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """``(host, page, template)`` of pages ``(host, page, html)``: those hashes of a page's subtrees that recur.

    They stand on pages of at least ``min_pages`` distinct main contents of the host; copies of a page count once. A
    page's list holds its own subtrees alone, however large its host is.
    """
    records = staged(pages.mapInArrow(_records, "host string, page string, content long, hashes array<long>"), "site-pages")
    distinct = records.groupBy("host", "content").agg(F.min("hashes").alias("hashes"))
    counts = distinct.select("host", F.explode("hashes").alias("hash")).groupBy("host", "hash").agg(F.count("*").alias("n"))
    common = counts.where(F.col("n") >= min_pages).select("host", "hash")
    own = records.groupBy("host", "page").agg(F.any_value("hashes").alias("hashes"))
    own = own.select("host", "page", F.explode("hashes").alias("hash"))
    return own.join(common, ["host", "hash"]).groupBy("host", "page").agg(F.collect_list("hash").alias("template"))


def _main_text(pages: pa.Array, templates: pa.Array) -> pa.Array:
    out = []
    for page, template in zip(texts_of(pages), templates.to_pylist()):
        hashes = {h & 0xFFFFFFFFFFFFFFFF for h in template} if template else frozenset()
        out.append(main_text(parse(page.decode()), hashes) if page else "")
    return pa.array(out, pa.string())


def extract_main_text(
    pages: DataFrame,
    html_col: str = "html",
    url_col: str = "url",
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """Every input row as struct ``doc``, with its main text: empty for a null or empty page.

    Character references are decoded, white space inside a block becomes one blank, and blocks are joined by
    one blank in page order. Pages without a host count as one site of their own.
    """
    rows = pages.select(packed(pages)).withColumn("host", host_of(F.col(DOC).getField(url_col)))
    html = F.col(DOC).getField(html_col)
    bounded_batches(pages.sparkSession)
    rows = rows.withColumn("page", F.md5(html.cast("binary")))
    # Written out, so that both sides of the join are shuffled for it and the pages of a large host can be split.
    templates = staged(site_templates(rows.select("host", "page", html.alias("html")), min_pages), "site-templates")
    read = F.arrow_udf(_main_text, "string")
    return rows.join(templates, ["host", "page"], "left").select(DOC, read(html, F.col("template")).alias("text"))
