"""A small tree of a page's block elements and of the stretches of inline text in them."""

from __future__ import annotations

import html
import re
from collections import Counter

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)([^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*)>?", re.S
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: Elements whose content is raw text up to the close tag, and no text of the page.
_RAW = {
    tag: re.compile(rf"</{tag}\b[^>]*>?", re.I)
    for tag in ("script", "style", "noscript", "iframe", "textarea", "title")
}
#: The next tag of these, to tell a close tag that is an element's own from one of a later element.
_NEXT = {tag: re.compile(rf"<(/?){tag}\b[^>]*>?", re.I) for tag in _RAW}
#: Elements with markup inside that is no text of the page. One without a close tag of its own is left out instead.
_DROPPED = frozenset("svg object select template".split())
#: A slash that ends an unquoted value closes nothing.
_UNQUOTED = re.compile(r"""=\s*[^\s"'=][^\s"'>]*\Z""")
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
_VOID = frozenset("area base col embed hr input link meta param source track".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An element that opens ends an open one of these, unless a container stands between.
_ENDS = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table tbody thead tfoot"),
         "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select")}


class Node:
    __slots__ = ("attributes", "children", "depth", "hidden", "index", "link", "parent", "tag", "text")

    def __init__(self, tag: str, parent: Node | None, attributes: str = "") -> None:
        self.tag, self.parent, self.children = tag, parent, []
        self.depth = parent.depth + 1 if parent else 0
        self.index = len(parent.children) if parent else 0
        self.text, self.link = "", 0
        self.attributes = self.hidden = None
        if attributes:
            named = " ".join(a or b or c for a, b, c in _NAMES.findall(attributes))
            self.attributes = frozenset(token.lower() for token in _TOKEN.findall(named)) if named else None
            self.hidden = bool(_HIDDEN.search(attributes))
        if parent:
            parent.children.append(self)


def _self_closed(attributes: str) -> bool:
    return attributes.endswith("/") and not _UNQUOTED.search(attributes)


def parse(page: str) -> list[Node]:
    """Nodes in page order, parents first. Leaves, with tag ``#text``, hold decoded text in single spaces.

    A first reading finds where dropped elements end that have a close tag of their own. If there are any dropped tags,
    a second one skips those elements and passes over the tags of the others.
    """
    nodes, ends = _read(page, None)
    return nodes if ends is None else _read(page, ends)[0]


def _read(page: str, skip: dict[int, int] | None) -> tuple[list[Node], dict[int, int] | None]:
    """The nodes, and by their start the ends of dropped elements that have a close tag of their own (None if the page has
    no tag of a dropped element). ``skip``: such ends as an earlier reading found them."""
    root = Node("#root", None)
    dropped: list[tuple[int, int]] = []  # depth and start of open dropped elements
    ends: dict[int, int] | None = None
    nodes, open_, links, run, linked, at = [root], [root], [0], [], 0, 0

    def add_text(raw: str) -> None:
        nonlocal linked
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            run.append(text)
            if links[-1]:
                linked += len(text.strip())

    def flush() -> None:
        nonlocal linked
        if run:
            text = " ".join("".join(run).split())
            if text and not dropped:
                leaf = Node("#text", open_[-1])
                leaf.text, leaf.link = text, min(linked, len(text))
                nodes.append(leaf)
            run.clear()
        linked = 0

    def close(depth: int, end: int | None = None) -> None:
        """Ends the open elements from ``depth`` on, the first of them by a close tag of its own that ends at ``end``."""
        while dropped and dropped[-1][0] >= depth:
            at_depth, start = dropped.pop()
            if end is not None and at_depth == depth:
                ends[start] = end
        for element in open_[depth:]:
            count[element.tag] -= 1
        del open_[depth:], links[depth:]

    count: Counter[str] = Counter()

    while True:
        found = _TAG.search(page, at)
        add_text(page[at : found.start()] if found else page[at:])
        if not found:
            break
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        if tag in _INLINE:
            if tag == "a":
                links[-1] = max(0, links[-1] + (-1 if found[1] else 1))
            elif tag == "br":
                run.append(" ")
            continue
        flush()
        if found[1]:
            same = _HEADINGS if tag in _HEADINGS else (tag,)
            if any(count[name] for name in same):
                depth = next(d for d in range(len(open_) - 1, 0, -1) if open_[d].tag in same)
                close(depth, found.end())
            continue
        if tag in _RAW:
            if tag == "noscript" or dropped:
                # Its content may also be markup: nothing is skipped without a close tag of its own.
                end = None if dropped and _self_closed(found[3]) else _NEXT[tag].search(page, at)
                at = end.end() if end and end[1] else at
            else:
                end = _RAW[tag].search(page, at)
                at = end.end() if end else len(page)
            continue
        if tag in _DROPPED:
            if skip is not None:
                at = skip.get(found.start(), at)
                continue
            ends = {} if ends is None else ends
            if not (tag == "svg" and _self_closed(found[3])):
                dropped.append((len(open_), found.start()))
                open_.append(Node(tag, None))
                count[tag] += 1
                links.append(links[-1])
            continue
        if open_[-1].tag == "p":
            close(len(open_) - 1)
        if tag in _ENDS:
            own, within = (names.split() for names in _ENDS[tag])
            for depth in range(len(open_) - 1, 0, -1):
                if open_[depth].tag in own:
                    close(depth)
                    break
                if open_[depth].tag in within or open_[depth].tag in _DROPPED:
                    break
        node = Node(tag, open_[-1], found[3])
        if not dropped:
            nodes.append(node)
        if tag not in _VOID:
            open_.append(node)
            count[tag] += 1
            links.append(links[-1])
    flush()
    return nodes, ends
