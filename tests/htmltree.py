"""Small helper for the nested-table gauge pages (run inside mapInPandas).

Some device pages put every gauge in a nested table addressed by row id:
``//tr[@id=k]/td[2]/table/tbody/tr/td/table/tbody/tr/td[2]`` (first match:
toner, second match: imaging unit).  Regexes cannot follow that nesting, so
each page is parsed once, with the standard-library HTML parser, into a light
tree, and the path is walked.  Nothing recurses, so deep pages are fine.  This
is per-page Python on Arrow batches: Spark still partitions the pages.
"""

from __future__ import annotations

from html.parser import HTMLParser

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
# A start tag ends open elements of these kinds, back to the nearest container.
_ENDS = {"td": {"td", "th"}, "th": {"td", "th"}, "tr": {"td", "th", "tr"}, "tbody": {"td", "th", "tr", "tbody"},
         "li": {"li"}, "p": {"p"}, "option": {"option"}}
_CONTAINER = {"table", "ul", "ol", "div", "select", "#root"}


class _Node:
    __slots__ = ("tag", "attrs", "parts")

    def __init__(self, tag: str, attrs: dict):
        self.tag, self.attrs, self.parts = tag, attrs, []          # parts: texts and nodes, in order

    def kids(self, tag: str) -> list[_Node]:
        return [c for c in self.parts if isinstance(c, _Node) and c.tag == tag]

    def walk(self):
        stack = [self]
        while stack:
            node = stack.pop()
            yield node
            if isinstance(node, _Node):
                stack.extend(reversed(node.parts))

    def text(self) -> str:
        return "".join(x for x in self.walk() if isinstance(x, str))


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = _Node("#root", {})
        self.stack = [self.root]

    def handle_starttag(self, tag, attrs):
        ends = _ENDS.get(tag, ())
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag in _CONTAINER or not ends:
                break
            if self.stack[i].tag in ends:
                del self.stack[i:]
        node = _Node(tag, dict(attrs))
        self.stack[-1].parts.append(node)
        if tag not in _VOID:
            self.stack.append(node)

    def handle_endtag(self, tag):
        for i in range(len(self.stack) - 1, 0, -1):       # lenient: close up to the match
            if self.stack[i].tag == tag:
                del self.stack[i:]
                return

    def handle_data(self, data):
        self.stack[-1].parts.append(data)


def _rows_of(table: _Node) -> list[_Node]:
    """``table/tbody/tr`` with the ``tbody`` a browser would insert."""
    bodies = table.kids("tbody")
    return [tr for b in bodies for tr in b.kids("tr")] if bodies else table.kids("tr")


def _nested_cells(tr: _Node) -> list[str]:
    """Texts of ``td[2]/table/tbody/tr/td/table/tbody/tr/td[2]`` below ``tr``."""
    outer = [t for td in tr.kids("td")[1:2] for t in td.kids("table")]
    inner = [t for o in outer for r in _rows_of(o) for td in r.kids("td") for t in td.kids("table")]
    return [r.kids("td")[1].text().strip() for t in inner for r in _rows_of(t) if len(r.kids("td")) > 1]


def row_id_texts(html: str | None, positions: int, matches: int = 2) -> list[str | None]:
    """Gauge ``(k-1)*matches + m`` is match ``m`` of the row with id ``k``; None where there is none."""
    out: list[str | None] = [None] * positions
    if not html:
        return out
    t = _Tree()
    t.feed(html)
    t.close()
    ids = {str(k + 1): k for k in range(positions // matches)}
    found: dict[int, list[str]] = {}
    for n in t.root.walk():
        if isinstance(n, _Node) and n.tag == "tr" and n.attrs.get("id") in ids:
            found.setdefault(ids[n.attrs["id"]], []).extend(_nested_cells(n))
    for k, texts in found.items():
        for m, text in enumerate(texts[:matches]):
            out[k * matches + m] = text
    return out
