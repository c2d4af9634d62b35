"""Feed links in page HTML, read as the tree that a lenient HTML parser builds.

Whole pages are read: nothing is cut off. The standard library's tokeniser gives tags, attributes, text and all
character references. Elements are closed as in a tree without rules about what may lie in what: an end tag
closes all elements opened since, and is passed over where no element of its name is open; an element that is never
closed ends with its parent or with the page; void elements hold nothing.
"""

from __future__ import annotations

from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Kinds of finds, in the order in which they are preferred.
FROM_LINK, FROM_ANCHOR = 1, 2
FOUND = "array<struct<priority:int,pos:int,href:string,title:string>>"
# Elements without content.
VOID = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex keygen link menuitem meta nextid"
    " param source spacer track wbr".split()
)
# Elements whose text is not text of the page.
APART = frozenset("rp rt script style template".split())
LINK_WORDS, ANCHOR_WORDS = ("rss", "atom"), ("rss", "feed", "atom")


class _Element:
    """An open element: how many children it has so far, and the sole text of the last of them."""

    __slots__ = ("name", "children", "text", "find")

    def __init__(self, name: str, find: dict | None = None):
        self.name, self.children, self.text, self.find = name, 0, None, find


class FeedReader(HTMLParser):
    """Collects the feed links of one page: link elements by their type, anchors by their sole text.

    An element's sole text is that of its only child: a text, a comment, or an element that has one itself.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open = [_Element("")]
        self.apart = 0
        self.pending: list[str] = []
        self.counts = {FROM_LINK: 0, FROM_ANCHOR: 0}
        self.named: dict[str, int] = {}
        self.found: list[dict] = []

    def _add(self, text: tuple[str, bool] | None) -> None:
        self.open[-1].children += 1
        self.open[-1].text = text

    def _flush(self) -> None:
        if self.pending:
            self._add(("".join(self.pending), not self.apart))
            self.pending = []

    def _find(self, kind: int, attributes: dict) -> dict:
        """An element that may be a find; its number counts the elements of its kind."""
        one = {"priority": kind, "pos": self.counts[kind], "href": attributes.get("href") or "", "title": None}
        self.counts[kind] += 1
        return one

    def _close(self) -> None:
        last = self.open.pop()
        self.named[last.name] -= 1
        self.apart -= last.name in APART
        text = last.text if last.children == 1 else None
        self.open[-1].text = text
        if last.find and text and any(w in text[0].lower() for w in ANCHOR_WORDS):
            self.found.append(last.find | {"title": text[0].strip() if text[1] else ""})

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._flush()
        find = None
        if tag == "link":
            own = dict(attrs)
            one, kind = self._find(FROM_LINK, own), own.get("type") or ""
            if one["href"] and any(w in kind for w in LINK_WORDS):
                self.found.append(one | {"title": (own["title"] or "") if "title" in own else None})
        elif tag == "a":
            one = self._find(FROM_ANCHOR, dict(attrs))
            find = one if one["href"] else None
        self._add(None)
        if tag not in VOID:
            self.open.append(_Element(tag, find))
            self.named[tag] = self.named.get(tag, 0) + 1
            self.apart += tag in APART

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._close()

    def handle_endtag(self, tag: str) -> None:
        self._flush()
        if self.named.get(tag):
            while self.open[-1].name != tag:
                self._close()
            self._close()

    def handle_data(self, data: str) -> None:
        self.pending.append(data)

    def handle_comment(self, data: str) -> None:
        self._flush()
        self._add((data, False))

    handle_decl = handle_pi = handle_comment

    def unknown_decl(self, data: str) -> None:
        self._flush()
        self._add((data.removeprefix("CDATA["), data.startswith("CDATA[")))

    def close(self) -> None:
        super().close()
        self._flush()
        while len(self.open) > 1:
            self._close()


def feeds_of(html: str) -> list[dict]:
    """Feed links of a page: link elements in order, then anchors in order; a missing title is null, an anchor's empty."""
    reader = FeedReader()
    reader.feed(html)
    reader.close()
    return sorted(reader.found, key=lambda f: (f["priority"], f["pos"]))


def feed_finds(html: Column) -> Column:
    """``feeds_of`` as a list of structs ``priority, pos, href, title``; of a null page empty."""
    kind = pa.list_(pa.struct([("priority", pa.int32()), ("pos", pa.int32()), ("href", pa.string()), ("title", pa.string())]))

    @F.arrow_udf(FOUND)
    def read(pages: pa.Array) -> pa.Array:
        return pa.array([feeds_of(page) if page else [] for page in pages.to_pylist()], kind)

    return read(html)
