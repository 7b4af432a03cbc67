"""Small HTML reader used inside tasks: tables, text blocks, list links."""

from __future__ import annotations

from html.parser import HTMLParser

# ---- fixed values -----------------------------------------------------------
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section"
    " table ul".split()
)
# An opening tag first closes the open elements in the first set, as far up as
# the second set.
CLOSES = {
    "li": ({"li"}, {"ul", "ol"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody"}, {"table"}),
}
CONTENT_CLASS = "mw-parser-output"
CHART_CLASSES = frozenset({"wikitable", "sortable"})
NAVBOX, NAVBOX_LIST, NAVBOX_LABEL = "navbox", "navbox-list", "Billboard_Year-End_Hot_100_singles"
HEADING_ID = "firstHeading"
# -----------------------------------------------------------------------------


class Node:
    __slots__ = ("tag", "attrs", "items")

    def __init__(self, tag: str, attrs=()):
        self.tag, self.attrs, self.items = tag, dict(attrs), []

    def walk(self, *tags: str):
        """Elements below this one, in document order."""
        todo = [x for x in reversed(self.items) if isinstance(x, Node)]
        while todo:
            node = todo.pop()
            if not tags or node.tag in tags:
                yield node
            todo.extend(x for x in reversed(node.items) if isinstance(x, Node))

    def texts(self) -> list[str]:
        out, todo = [], list(reversed(self.items))
        while todo:
            item = todo.pop()
            if isinstance(item, str):
                out.append(item)
            else:
                todo.extend(reversed(item.items))
        return out

    def classes(self) -> set[str]:
        return set((self.attrs.get("class") or "").split())


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("")
        self.open = [self.root]

    def _close(self, tags, barrier) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in tags:
                del self.open[i:]
                return
            if self.open[i].tag in barrier:
                return

    def handle_starttag(self, tag, attrs):
        if tag in ENDS_PARAGRAPH:
            self._close({"p"}, {"td", "th", "li", "table"})
        if tag in CLOSES:
            self._close(*CLOSES[tag])
        node = Node(tag, attrs)
        self.open[-1].items.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_endtag(self, tag):
        self._close({tag}, {"table"} if tag not in ("table", "html", "body") else ())

    def handle_data(self, data):
        self.open[-1].items.append(data)


def parse(html: str) -> Node:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


def heading(root: Node) -> str | None:
    for h in root.walk("h1"):
        if h.attrs.get("id") == HEADING_ID:
            return next((x for x in h.items if isinstance(x, str)), None)
    return None


def chart_rows(root: Node):
    """(table, row, place, name, href, artist) of each chart row with three cells or more."""
    charts = [t for t in root.walk("table") if CHART_CLASSES <= t.classes()]
    for t, chart in enumerate(charts):
        # A row of a nested table lies in two bodies but is one row.
        rows = {id(r): r for body in chart.walk("tbody") for r in body.walk("tr")}
        for r, row in enumerate(rows.values()):
            cells = list(row.walk("td"))
            if len(cells) < 3:
                continue
            first = cells[0].texts()
            href = next((a.attrs["href"] for a in cells[1].walk("a") if a.attrs.get("href")), None)
            name = "".join(cells[1].texts()).strip().strip('"')
            yield t, r, first[0].strip() if first else None, name, href, "".join(cells[2].texts()).strip()


def _joined(node: Node) -> str:
    return " ".join(node.texts()).strip()


def text_blocks(root: Node):
    """(layout, index, text): list items, direct paragraphs, wiki table rows."""
    layouts: tuple[list, list, list] = ([], [], [])
    for box in root.walk("div"):
        if CONTENT_CLASS not in (box.attrs.get("class") or ""):
            continue
        for listing in box.walk("ul", "ol"):
            layouts[0].extend(x for x in listing.items if isinstance(x, Node) and x.tag == "li")
        layouts[1].extend(x for x in box.items if isinstance(x, Node) and x.tag == "p")
        for t in box.walk("table"):
            if "wikitable" in (t.attrs.get("class") or ""):
                cells = {"td", "th"}
                layouts[2].extend(r for r in t.walk("tr") if any(isinstance(x, Node) and x.tag in cells for x in r.items))
    for layout, nodes in enumerate(layouts):
        for i, node in enumerate(nodes):
            text = _joined(node)
            if text:
                yield layout, i, text


def list_links(root: Node, everywhere: bool = False):
    """(index, href, label) of links in list items of the year navigation box."""
    if everywhere:
        areas = [root]
    else:
        boxes = [
            d for d in root.walk("div")
            if NAVBOX in d.classes() and (d.attrs.get("aria-labelledby") or "").startswith(NAVBOX_LABEL)
        ]
        areas = [x for b in boxes for x in b.walk() if NAVBOX_LIST in x.classes()]
    links = [a for area in areas for li in area.walk("li") for a in li.walk("a")]
    for i, a in enumerate(links):
        texts = a.texts()
        if a.attrs.get("href") and texts:
            yield i, a.attrs["href"], texts[0]
