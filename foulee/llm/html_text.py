"""Main text of web pages: boosted trees over DOM nodes, then one consistent choice for the whole tree.

A node's features are its tag and its ancestors' tags, tokens of class, id and role in groups, depth,
subtree density, share of link text, punctuation, whether its lines end as sentences do, its share of the page's prose
(text that is no link), the statistics of its siblings, and what its parent and grandparent hold. The trees are fitted
by Spark ML on nodes of generated pages whose layout, and so whose labels, are known (``TRAINING_PAGES``, a
documented bound; no page of the table is needed). Each task scores the nodes of many pages at once.

Decoding: an element that holds one stretch of text and nothing else stays or goes with it, so both get the mean of their
log odds. Then a node's log odds and the best of its subtrees add up from the leaves to the root; from the root
down, a subtree is kept if its sum is positive. So nothing is kept inside what is dropped, and a container
goes with what it holds, whatever its own score.

Cases: null and empty pages, and pages without main text, give an empty text. Broken, unclosed and very
deep markup is read like any other; nothing of the kept text is cut. Repeated rows give equal results.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foulee.llm.dom import Node, parse
from foulee.llm.frames import annotate, map_arrow, read

TRAINING_PAGES = 2400
TREES = 40
DEPTH = 6
#: Tasks that measure the training pages, and the rows of a block, which goes to one of them as a whole.
SLICES = 4
DEALT = 1024

_TAGS = "p h1 h2 h3 div article main section ul ol li table tr td blockquote pre figure figcaption dl nav header footer aside form button label hr #text".split()
_ABOVE = "article main section ul ol table blockquote pre figure nav header footer aside form button".split()
#: Words in class, id and role, by what they usually say about an element.
GROUPS = {
    "content": "article content post entry main body story prose text blog",
    "menu": "nav menu navbar navigation breadcrumb breadcrumbs pagination pager toc tabs links",
    "head": "header masthead top banner logo branding hero",
    "foot": "footer bottom copyright legal colophon",
    "side": "sidebar side aside rail widget related recommended more trending popular",
    "advert": "ad ads advert advertisement adsense sponsor sponsored promo promoted promotion",
    "notice": "cookie cookies consent notice alert gdpr popup modal overlay dialog newsletter subscribe paywall",
    "comment": "comment comments reply replies respond disqus discussion thread",
    "share": "share social follow tweet sharing",
    "form": "form login search signup register contact",
    "meta": "meta byline author date tags category caption",
}
_GROUP_OF = {word: i for i, words in enumerate(GROUPS.values()) for word in words.split()}
_MARKS = re.compile(r"[.,;:!?]")
_ENDS = tuple(".!?:;\u2026\"\u201d\u00bb)")
_OWNERS = re.compile(r"\u00a9|\(c\)|copyright|rights reserved", re.I)
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Marks the kept text of generated pages; removed before anything is measured.
_KEPT = ""


_TAG_INDEX = {tag: i for i, tag in enumerate(_TAGS)}
_ABOVE_BIT = {tag: 1 << i for i, tag in enumerate(_ABOVE)}


def measured(nodes: Sequence[Node]) -> list[tuple]:
    """For each node its tag, bits of tags above, of own groups and of groups above, and its numbers."""
    n = len(nodes)
    place = {id(node): i for i, node in enumerate(nodes)}
    parents = [place.get(id(node.parent), -1) for node in nodes]
    text, link, marks, words, tags, lines, ended, owners, paragraphs, headings = ([0] * n for _ in range(10))
    for i in range(n - 1, -1, -1):
        node, up = nodes[i], parents[i]
        if node.text:
            text[i], link[i] = len(node.text), node.link
            marks[i], words[i] = len(_MARKS.findall(node.text)), node.text.count(" ") + 1
            lines[i], ended[i] = 1, int(node.text.endswith(_ENDS))
            owners[i] = int(bool(_OWNERS.search(node.text)))
        elif node.tag != "#text":
            tags[i] += 1
        if up >= 0:
            text[up] += text[i]
            link[up] += link[i]
            marks[up] += marks[i]
            words[up] += words[i]
            tags[up] += tags[i]
            lines[up] += lines[i]
            ended[up] += ended[i]
            owners[up] += owners[i]
            paragraphs[up] += node.tag == "p"
            headings[up] += node.tag in _HEADING
    passed: list[tuple[int, int, bool]] = []  # what each node hands down: tags, groups, hidden
    rows = []
    total, prose = max(text[0], 1), max(text[0] - link[0], 1)
    for i, node in enumerate(nodes):
        up = parents[i]
        tag_bits, group_bits, hidden = passed[up] if up >= 0 else (0, 0, False)
        own_bits = 0
        if node.attributes:
            for token in node.attributes:
                if token in _GROUP_OF:
                    own_bits |= 1 << _GROUP_OF[token]
        hidden = hidden or bool(node.hidden)
        siblings, outer = (len(node.parent.children), up) if up >= 0 else (1, i)
        further = parents[outer] if parents[outer] >= 0 else outer
        before = node.parent.children[node.index - 1].tag if up >= 0 and node.index else ""
        rows.append(
            (
                _TAG_INDEX.get(node.tag, len(_TAGS)), tag_bits, own_bits, group_bits, hidden, node.depth,
                text[i], link[i], marks[i], words[i], tags[i], len(node.children), node.index, siblings,
                text[outer], link[outer], marks[outer], words[outer], total,
                lines[i], ended[i], owners[i], paragraphs[i], headings[i], (text[i] - link[i]) / prose,
                lines[outer], ended[outer], owners[outer], paragraphs[outer], headings[outer], (text[outer] - link[outer]) / prose,
                paragraphs[further], (text[further] - link[further]) / prose, before in _HEADING, before == "p",
            )
        )
        passed.append((tag_bits | _ABOVE_BIT.get(node.tag, 0), group_bits | own_bits, hidden))
    return rows


def features(rows: Sequence[tuple]) -> np.ndarray:
    """The trees' features of nodes that were measured, of any number of pages."""
    table = np.array(rows, np.float64)
    tag, above, own, group = table[:, :4].astype(np.int64).T
    hidden, depth, text, link, marks, words, tags, children, index, siblings, text_up, link_up, marks_up, words_up, total = table[:, 4:19].T
    lines, ended, owners, paragraphs, headings, prose, lines_up, ended_up, owners_up, paragraphs_up, headings_up = table[:, 19:30].T
    prose_up, paragraphs_above, prose_above, after_heading, after_paragraph = table[:, 30:].T
    bits = lambda x, n: x[:, None] >> np.arange(n) & 1
    least = lambda x: np.maximum(x, 1)
    numbers = [
        hidden, depth, np.log1p(text), text / total, link / least(text), marks / least(words), np.log1p(words),
        text / (tags + 1), children, index / siblings, np.log1p(siblings), text / (text_up / siblings + 1),
        text_up / total, link_up / least(text_up), marks_up / least(words_up),
        lines, ended / least(lines), owners, paragraphs, headings, prose, ended_up / least(lines_up), owners_up, paragraphs_up,
        headings_up, prose_up, paragraphs_above, prose_above, after_heading, after_paragraph,
    ]
    kinds = (tag[:, None] == np.arange(len(_TAGS))).astype(np.float64)
    return np.column_stack([kinds, bits(above, len(_ABOVE)), bits(own, len(GROUPS)), bits(group, len(GROUPS)), *numbers])


# --- Generated pages ---------------------------------------------------------------------------------


def _words(rng: random.Random, low: int, high: int, prose: bool | None = None) -> str:
    """Invented words. Prose has the marks and capitals that prose has and ends as a sentence; what is no prose has few."""
    out, begins, count = [], True, rng.randint(low, high)
    prose = count > 4 if prose is None else prose
    for i in range(count):
        word = "".join(rng.choice("aeioulnrst") + rng.choice("bcdfghmnprst") for _ in range(rng.choice([1, 1, 2, 2, 3, 4])))
        mark = rng.random() if prose and i + 1 < count else 1
        out.append((word.capitalize() if begins or not prose and rng.random() < 0.3 else word) + (", " if mark < 0.08 else ". " if mark < 0.16 else " "))
        begins = 0.08 <= mark < 0.16
    return "".join(out).strip() + (rng.choice([".", ".", ".", ".", "!", "?", ":", ""]) if prose else "")


def _element(rng: random.Random, tag: str, group: str | None, inside: str) -> str:
    """An element that, more often than not, is named after what it is."""
    names = ""
    # What is no article says so more often: pages style it apart.
    if group and rng.random() < (0.75 if group == "content" else 0.9):
        word = rng.choice(GROUPS[group].split())
        word = rng.choice([word, f"{word}-{rng.choice(['box', 'wrap', 'list', 'area'])}", f"site-{word}", f"{word}{rng.randint(1, 9)}"])
        names = f' {rng.choice(["class", "class", "id"])}="{word}"'
    elif rng.random() < 0.3:
        names = f' class="c{rng.randint(1, 99)} {rng.choice(["row", "col", "box", "inner"])}"'
    return f"<{tag}{names}>{inside}</{tag}>"


def _links(rng: random.Random, low: int = 2, high: int = 9) -> str:
    if rng.random() < 0.05:
        return _words(rng, 1, 3, False)
    longest = rng.choice([2, 3, 3, 9])  # teasers of other pages are longer
    links = [f'<a href="/{i}">{_words(rng, 1, longest, False)}</a>' for i in range(rng.randint(low, high))]
    if rng.random() < 0.6:
        return "<ul>" + "".join(f"<li>{link}</li>" for link in links) + "</ul>"
    return rng.choice([" | ", " ", ""]).join(links)


def _boilerplate(rng: random.Random, kind: str) -> str:
    text = _words(rng, 2, 30)
    if kind == "menu":
        return _element(rng, rng.choice(["nav", "nav", "div", "div", "ul"]), rng.choice(["menu", "menu", None]), _links(rng))
    if kind == "head":
        title = rng.choice([f"<h1>{_words(rng, 1, 4, False)}</h1>", _words(rng, 1, 6, False), f'<a href="/">{_words(rng, 1, 3, False)}</a>'])
        menu = rng.choice(["", "", _links(rng), f"<nav>{_links(rng)}</nav>"])
        return _element(rng, rng.choice(["header", "header", "div"]), "head", title + menu)
    if kind == "foot":
        owner = f"{rng.choice(['&copy;', '&copy;', 'Copyright', '(c)'])} {rng.choice(['', '2019 ', '2024 '])}{_words(rng, 1, 12)}{rng.choice(['', ' All rights reserved.'])}"
        owner = rng.choice(["{}", "<p>{}</p>", "<small>{}</small>"]).format(owner)
        inside = rng.choice(["", "", f"<p>{text}</p>", _links(rng)]) + (owner if rng.random() < 0.85 else f"<p>{text}</p>")
        return _element(rng, rng.choice(["footer", "footer", "div"]), rng.choice(["foot", "foot", None]), inside)
    if kind == "side":
        inside = "".join(f"<h3>{_words(rng, 1, 3)}</h3>{rng.choice([_links(rng), f'<p>{text}</p>'])}" for _ in range(rng.randint(1, 3)))
        return _element(rng, rng.choice(["aside", "aside", "div"]), "side", inside)
    if kind == "advert":
        return _element(rng, rng.choice(["div", "div", "aside", "section"]), "advert", rng.choice([text, f"<p>{text}</p>", f'<a href="x">{text}</a>']))
    if kind == "notice":
        return _element(rng, rng.choice(["div", "section", "aside"]), "notice", rng.choice([text, f"<p>{text}</p>"]) + rng.choice(["", f"<button>{_words(rng, 1, 2)}</button>"]))
    if kind == "form":
        fields = "".join(f"<label>{_words(rng, 1, 3)}</label><input name=q>" for _ in range(rng.randint(1, 3)))
        return _element(rng, "form", "form", f"{rng.choice(['', f'<p>{text}</p>'])}{fields}<button>{_words(rng, 1, 2)}</button>")
    if kind == "share":
        return _element(rng, "div", "share", _links(rng, 2, 4))
    inside = "".join(
        _element(rng, rng.choice(["div", "div", "div", "li", "li", "p", "p", "article"]), "comment", f"<b>{_words(rng, 1, 2)}</b> {rng.choice([_words(rng, 3, 60), f'<p>{_words(rng, 3, 60)}</p>'])}")
        for _ in range(rng.randint(1, 5))
    )
    return _element(rng, rng.choice(["section", "div", "div", "ol"]), "comment", f"{rng.choice(['', f'<h3>{_words(rng, 1, 3)}</h3>'])}{inside}")


def _article(rng: random.Random) -> str:
    """Kept blocks, and now and then an advert or share links between them."""
    keep = lambda low, high: _KEPT + _words(rng, low, high)
    heading = lambda low, high: _KEPT + _words(rng, low, high, rng.random() < 0.1)
    out = [rng.choice([f"<h1>{heading(1, 9)}</h1>", f"<h1>{heading(1, 9)}</h1>", f"<h2>{heading(1, 9)}</h2>", ""])]
    if rng.random() < 0.2:
        out[0] = f"<header>{out[0]}</header>"
    count = rng.choice([1, 1, 1, 2, 2, 3, 3, 5, 8, 12, 20])
    for _ in range(count):
        kind = rng.random() * (0.7 if count == 1 else 1)
        if kind < 0.68:
            block = _KEPT + _words(rng, 1, rng.choice([2, 8, 40, 90]), rng.random() < 0.9)
            if rng.random() < 0.3:
                # A link of a few words or of most of the paragraph, at its end or within it.
                link = f'<a href="y">{_words(rng, 1, rng.choice([3, 3, 8, 16]), False)}</a>'
                block = rng.choice([f"{block} {link}", f"{block} {link}.", f"{block} {link} {_words(rng, 1, 30)}", f"{keep(1, 3)} {link}."])
            out.append(rng.choice(["<p>{}</p>", "<p>{}</p>", "<p>{}</p>", "<p>{}", "<p><b>{}<br>", "<div>{}</div>"]).format(block))
        elif kind < 0.76:
            level = rng.randint(2, 4)
            out.append(f"<h{level}>{heading(1, 6)}</h{level}>")
        elif kind < 0.82:
            tag = rng.choice(["ul", "ol"])
            out.append(f"<{tag}>" + "".join(f"<li>{keep(1, 25)}</li>" for _ in range(rng.randint(1, 6))) + f"</{tag}>")
        elif kind < 0.86:
            out.append(f"<blockquote>{rng.choice(['{}', '<p>{}</p>']).format(keep(3, 50))}</blockquote>")
        elif kind < 0.89:
            out.append("<table>" + "".join(f"<tr><td>{keep(1, 5)}</td><td>{keep(1, 5)}</td></tr>" for _ in range(rng.randint(1, 5))) + "</table>")
        elif kind < 0.91:
            out.append(f"<pre>{keep(3, 40)}</pre>")
        elif kind < 0.93:
            out.append(f"<figure><img src=z><figcaption>{keep(2, 12)}</figcaption></figure>")
        else:
            out.append(_boilerplate(rng, rng.choice(["advert", "advert", "share", "notice", "side", "form"])))
    return "".join(out)


def generated_page(rng: random.Random) -> str:
    """A page whose kept blocks begin with the mark."""
    some = lambda kinds, chance: "".join(_boilerplate(rng, k) for k in kinds if rng.random() < chance)
    inside = _article(rng) if rng.random() < 0.97 else ""
    wrap = rng.choice(["article"] * 4 + ["main"] * 2 + ["div"] * 4 + ["section"] * 2 + [""])
    # Without a wrapper the blocks are the body's own.
    main = _element(rng, wrap, rng.choice(["content", None, None]), inside) if wrap else inside
    if rng.random() < 0.4:
        main = _element(rng, rng.choice(["main", "div", "section"]), rng.choice(["content", None]), some(["menu", "advert"], 0.2) + main + some(["share", "comment", "side"], 0.3))
    for _ in range(rng.choice([0, 0, 0, 1, 2])):
        main = f"<div>{main}</div>"
    parts = [some(["notice", "head", "menu", "form", "advert"], 0.45), main, some(["share", "comment", "side", "advert", "notice", "form"], 0.3), some(["foot"], 0.8)]
    if rng.random() < 0.15:
        parts[1], parts[2] = parts[2], parts[1]
    body = "".join(parts)
    if rng.random() < 0.05:  # a page without an article
        body = "".join(_boilerplate(rng, rng.choice(["menu", "menu", "head", "foot", "form", "notice"])) for _ in range(rng.choice([1, 1, 2])))
    if rng.random() < 0.2:
        body = _element(rng, "div", None, body)
    page = f"<html><head><title>{_words(rng, 2, 6)}</title></head><body>{body}</body></html>"
    return page[: rng.randint(len(page) // 2, len(page))] if rng.random() < 0.05 else page


def labelled(page: str) -> tuple[list[Node], list[float]]:
    """Nodes of a generated page, marks removed, and 1 for each that is or holds kept text."""
    nodes = parse(page)
    kept = {id(node) for node in nodes if _KEPT in node.text}
    for node in nodes:
        node.text = node.text.replace(_KEPT, "")
    for node in reversed(nodes):
        if id(node) in kept and node.parent is not None:
            kept.add(id(node.parent))
    return nodes, [float(id(node) in kept) for node in nodes]


# --- Trees -------------------------------------------------------------------------------------------

_LINE = re.compile(r"If \(feature (\d+) (<=|>) ([-\d.eE]+)\)|Else|Predict: ([-\d.eE]+)|Tree \d+ \(weight ([-\d.eE]+)\)")


class Trees:
    """A boosted ensemble as arrays, read from Spark ML's description of its model."""

    def __init__(self, described: str) -> None:
        self.trees: list[tuple[np.ndarray, ...]] = []
        self.weights: list[float] = []
        rows: list[list[float]] = []
        open_: list[list[int]] = []  # inner nodes whose second branch is still to come
        for line in described.splitlines():
            found = _LINE.search(line)
            if not found:
                continue
            if found[5]:
                if rows:
                    self._add(rows)
                rows, open_ = [], []
                self.weights.append(float(found[5]))
            elif found[1] or found[4]:
                self._hang(rows, open_)
                if found[1]:
                    rows.append([int(found[1]), float(found[3]), -1, -1, 0.0])
                    open_.append([len(rows) - 1, 2])
                else:
                    rows.append([-1, 0.0, -1, -1, float(found[4])])
        if rows:
            self._add(rows)

    @staticmethod
    def _hang(rows: list[list[float]], open_: list[list[int]]) -> None:
        """The node about to be added is the next branch of the innermost open node."""
        if open_:
            top = open_[-1]
            rows[top[0]][top[1]] = len(rows)
            top[1] += 1
            while open_ and open_[-1][1] > 3:
                open_.pop()

    def _add(self, rows: list[list[float]]) -> None:
        table = np.array(rows)
        self.trees.append((table[:, 0].astype(int), table[:, 1], table[:, 2:4].astype(int), table[:, 4]))

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for weight, (feature, threshold, children, value) in zip(self.weights, self.trees):
            at = np.zeros(len(x), int)
            while True:
                inner = feature[at] >= 0
                if not inner.any():
                    break
                right = x[np.arange(len(x)), np.maximum(feature[at], 0)] > threshold[at]
                at = np.where(inner, children[at, right.astype(int)], at)
            total += weight * value[at]
        return 2 * total


def training_rows(spark: SparkSession, n_pages: int, seed: int) -> DataFrame:
    """Features ``x`` and ``label`` of each node of generated pages. The driver draws the pages, whose number is fixed;
    their nodes, a hundred times as large, are measured in tasks and stay there. Rows are dealt to ``SLICES`` tasks in
    order and then round robin, on every cluster alike, as Spark ML's thresholds come from a sample of each partition."""
    rng = random.Random(seed)
    pages = [generated_page(rng) for _ in range(n_pages)]
    begins = np.cumsum([0, *(len(parse(page)) for page in pages)])
    blocks = -(-int(begins[-1]) // DEALT)
    cuts = [min(i * blocks // SLICES * DEALT, int(begins[-1])) for i in range(SLICES + 1)]
    slices = []
    for low, high in zip(cuts, cuts[1:]):
        first, last = int(np.searchsorted(begins, low, "right")) - 1, int(np.searchsorted(begins, high))
        slices.append((pages[first:last], low - int(begins[first]), high - low))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one in (row for batch in batches for row in batch.to_pylist()):
            skip, left = one["skip"], one["n"]
            for page in one["pages"]:
                nodes, labels = labelled(page)
                x, y = features(measured(nodes))[skip : skip + left], labels[skip : skip + left]
                skip, left = 0, left - len(y)
                offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1])
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(offsets, pa.array(x.ravel())), pa.array(y, pa.float64())], ["x", "label"])

    frame = spark.createDataFrame(spark.sparkContext.parallelize(slices, SLICES), "pages array<string>, skip long, n long")
    return map_arrow(frame, run, "x array<double>, label double").repartition(SLICES)


def fit(spark: SparkSession, n_pages: int = TRAINING_PAGES, seed: int = 7) -> Trees:
    """Boosted trees for generated pages, fitted by Spark ML."""
    frame = training_rows(spark, n_pages, seed).select(array_to_vector("x").alias("features"), "label").cache()
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=seed, maxBins=64).fit(frame)
    frame.unpersist()
    return Trees(model.toDebugString)


_FITTED: dict[int, Trees] = {}


def fitted(spark: SparkSession) -> Trees:
    """The default trees, fitted once for each driver."""
    if TRAINING_PAGES not in _FITTED:
        _FITTED[TRAINING_PAGES] = fit(spark)
    return _FITTED[TRAINING_PAGES]


def together(nodes: Sequence[Node], odds: np.ndarray) -> np.ndarray:
    """``odds`` with the mean of both for an element and its only child, where that is text."""
    out = odds.copy()
    place = {id(node): i for i, node in enumerate(nodes)}
    for i, node in enumerate(nodes):
        if node.text and node.parent is not None and len(node.parent.children) == 1 and node.parent.parent is not None:
            up = place[id(node.parent)]
            out[i] = out[up] = (odds[i] + odds[up]) / 2
    return out


def chosen(nodes: Sequence[Node], odds: np.ndarray) -> list[str]:
    """Texts of the leaves in the best choice that keeps no node under one that goes."""
    best = odds.tolist()
    place = {id(node): i for i, node in enumerate(nodes)}
    for i in range(len(nodes) - 1, 0, -1):
        if best[i] > 0:
            best[place[id(nodes[i].parent)]] += best[i]
    kept, out = {id(nodes[0])}, []
    for i in range(1, len(nodes)):
        node = nodes[i]
        if best[i] > 0 and id(node.parent) in kept:
            kept.add(id(node))
            if node.text:
                out.append(node.text)
    return out


def extract(pages: DataFrame, html_col: str, keep: Sequence[str], trees: Trees | None = None, name: str = "text") -> DataFrame:
    """Columns ``keep`` and the main text of each page, its blocks separated by an empty line."""
    model = pages.sparkSession.sparkContext.broadcast(trees or fitted(pages.sparkSession))

    def make():
        own = model.value

        def work(texts):
            trees_of = [parse((text or b"").decode()) for text in texts]
            rows = [row for nodes in trees_of for row in measured(nodes)]
            odds, at, out = own.log_odds(features(rows)), 0, []
            for nodes in trees_of:
                out.append("\n\n".join(chosen(nodes, together(nodes, odds[at : at + len(nodes)]))))
                at += len(nodes)
            return [pa.array(out, pa.string())]

        return work

    return annotate(pages, html_col, keep, [T.StructField(name, T.StringType())], make)


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract(read(spark, sf_dir, "pages"), "html", ["page_id", "url"])
    return found.withColumn("n_chars", F.length("text").cast("long"))
