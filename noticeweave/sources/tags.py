"""Markup as a tree of tags, also where end tags are missing or too many: text of pages, and entries of result lists.

A page is read once, in one pass that holds the open elements; elements are rows that know where their text begins and ends among the page's
pieces of text, so nothing is copied for nested ones. Named and numeric references are decoded by the full table of the standard."""

from __future__ import annotations

from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeweave.functions.text import CUT_MARK, HIDDEN_TAGS, absolute_url

# Elements without content; elements that end an open one of the same list or table, and the elements they can't end it through.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}


class TagTree(HTMLParser):
    """names, attributes, parents and spans of all elements in their order, and the page's pieces of text."""

    def __init__(self, page: str):
        super().__init__(convert_charrefs=True)
        self.names: list[str] = []
        self.attributes: list[dict[str, str]] = []
        self.parents: list[int] = []
        self.spans: list[list[int]] = []
        self.last: list[int] = []  # the last element inside each
        self.pieces: list[list[str]] = []  # each in the parts that the parser gave
        self._between = True
        self._open: list[int] = []
        self._count: dict[str, int] = {}
        self._hidden = 0
        self.feed(page)
        self.close()
        while self._open:
            self._end()

    def _end(self) -> None:
        self._between = True
        i = self._open.pop()
        self._count[self.names[i]] -= 1
        self._hidden -= self.names[i] in HIDDEN_TAGS
        self.spans[i][1], self.last[i] = len(self.pieces), len(self.names) - 1

    def _imply(self, name: str) -> None:
        ended, borders = IMPLIED[name]
        if not any(self._count.get(n) for n in ended):
            return
        for depth in range(len(self._open) - 1, -1, -1):
            own = self.names[self._open[depth]]
            if own in borders:
                return
            if own in ended:
                while len(self._open) > depth:
                    self._end()
                if name != "tr":
                    return

    def handle_starttag(self, name: str, attributes: list[tuple[str, str | None]]) -> None:
        if name in IMPLIED:
            self._imply(name)
        self._between = True
        i = len(self.names)
        self.names.append(name)
        self.attributes.append({k: v or "" for k, v in reversed(attributes)})
        self.parents.append(self._open[-1] if self._open else -1)
        self.spans.append([len(self.pieces), len(self.pieces)])
        self.last.append(i)
        if name not in VOID:
            self._open.append(i)
            self._count[name] = self._count.get(name, 0) + 1
            self._hidden += name in HIDDEN_TAGS

    def handle_startendtag(self, name: str, attributes: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(name, attributes)
        if name not in VOID:
            self._end()

    def handle_endtag(self, name: str) -> None:
        if self._count.get(name):
            while self.names[self._open[-1]] != name:
                self._end()
            self._end()

    def handle_data(self, data: str) -> None:
        if self._hidden:
            return
        if self._between:
            self.pieces.append([])
            self._between = False
        self.pieces[-1].append(data)

    def _apart(self, _: str) -> None:
        self._between = True

    handle_comment = handle_decl = handle_pi = unknown_decl = _apart

    def text(self, i: int | None = None, sign: str = " ") -> str:
        """The text inside an element, or of the page: its pieces trimmed, the blank ones left out, joined."""
        begin, end = (0, len(self.pieces)) if i is None else self.spans[i]
        return sign.join(p for p in ("".join(piece).strip() for piece in self.pieces[begin:end]) if p)

    def inside(self, i: int) -> range:
        """The elements inside one, in their order."""
        return range(i + 1, self.last[i] + 1)

    def under(self, i: int, name: str, top: int) -> bool:
        """Whether an element lies in one of this name, inside top."""
        i = self.parents[i]
        while i > top:
            if self.names[i] == name:
                return True
            i = self.parents[i]
        return False


def visible_text(page: str | None, most: int | None = None) -> str:
    """The text of a page without hidden elements, single spaces; cut behind `most` characters, with a mark, if given."""
    told = " ".join(TagTree(page or "").text().split())
    return told[:most] + CUT_MARK if most is not None and len(told) > most else told


def page_text(c: Column | str, most: int | None = None) -> Column:
    """visible_text() of a column, in Arrow batches; null is empty."""

    @F.arrow_udf("string")
    def run(pages: pa.Array) -> pa.Array:
        return pa.array((visible_text(p.as_py(), most) for p in pages), pa.string())

    return run(c)


def _plain(tree: TagTree, i: int | None) -> str:
    return "" if i is None else unescape(tree.text(i, ""))


def _item(tree: TagTree, i: int, labels: list[str]) -> dict:
    inner = tree.inside(i)
    links = [k for k in inner if tree.names[k] == "a"]
    first = next((k for k in links if "result--subtitle" in tree.attributes[k].get("class", "").split()), None)
    title, href = _plain(tree, first), tree.attributes[first].get("href", "").strip() if first is not None else ""
    if not title:
        heading = next((k for k in links if tree.under(k, "h2", i)), None)
        if heading is not None:
            title, href = _plain(tree, heading), tree.attributes[heading].get("href", href)
    pdf = next((tree.attributes[k]["href"] for k in links if ".pdf" in tree.attributes[k].get("href", "")), "")
    told: dict[str, str] = {}
    for k in inner:
        if tree.names[k] == "dt" and tree.under(k, "dl", i):
            label = _plain(tree, k).lower()
            if label in labels and label not in told:
                told[label] = _plain(tree, next((d for d in range(tree.last[k] + 1, tree.last[i] + 1) if tree.names[d] == "dd" and tree.parents[d] == tree.parents[k]), None))
    return {"title": title, "href": href, "pdf": pdf, "terms": [told.get(label, "") for label in labels]}


def list_items(page: str | None, list_id: str, labels: list[str]) -> list[dict]:
    """title, href, pdf and terms of the items directly in any list inside the element of an id; lists elsewhere on the page don't count."""
    tree = TagTree(page or "")
    whole = next((i for i, a in enumerate(tree.attributes) if a.get("id") == list_id), None)
    if whole is None:
        return []
    return [_item(tree, i, labels) for i in tree.inside(whole) if tree.names[i] == "li" and tree.names[tree.parents[i]] == "ul" and tree.parents[i] > whole]


def result_items(pages: DataFrame, html: str, base: str, list_id: str, terms: dict[str, str]) -> DataFrame:
    """The entries of result lists: all columns of pages but html, and position, title, url, pdf and the named terms (dt and dd, by their
    labels whatever their case).

    Title and url come from the link of class result--subtitle, else from the heading's; pdf is the first link to one. Entries without title or
    url are left out."""
    labels = [label.lower() for label in terms.values()]

    @F.arrow_udf("array<struct<title: string, href: string, pdf: string, terms: array<string>>>")
    def run(values: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("title", pa.string()), ("href", pa.string()), ("pdf", pa.string()), ("terms", pa.list_(pa.string()))]))
        return pa.array((list_items(v.as_py(), list_id, labels) for v in values), kind)

    kept = [c for c in pages.columns if c != html]
    items = pages.select(*kept, F.posexplode(run(html)).alias("position", "__item"))
    item = F.col("__item")
    out = items.select(*kept, "position", item["title"].alias("title"), absolute_url(item["href"], base).alias("url"), absolute_url(item["pdf"], base).alias("pdf"), *[item["terms"][i].alias(n) for i, n in enumerate(terms)])
    return out.where("title <> '' AND url <> ''")
