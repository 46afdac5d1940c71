"""Main text of web pages by a tree-structured graphical model.

The nodes are the elements of a page, each either content or not. Potentials
join a parent and its child; what an element looks like speaks for or against
it. Messages pass from the leaves to the root and back, which gives the exact
probability of content for each element. Text is taken from elements that are
more likely content.

All potentials come from counts over labelled pages, which Spark adds up.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import column_of, parts, plain

#: Labelled pages that the model is fitted on, the first by hash of their html.
SAMPLE = 600
_SMOOTH, _OTHER = 0.5, "#other"

# Element names of the HTML standard, by how a parser treats them (fixed values).
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript template iframe svg object noframes noembed xmp".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong "
    "sub sup time tt u var wbr "
    "math maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot mrow ms mspace msqrt mstyle msub "
    "msubsup msup mtable mtd mtext mtr munder munderover semantics annotation".split()
)
#: Elements that may stand in a head; any other ends it.
_IN_HEAD = frozenset("head base basefont bgsound link meta title style script noscript noframes template".split())
_CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr "
    "main menu nav ol p pre section table ul".split()
)
_CLOSED_BY_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPE = frozenset("ul ol dl table div article section main body aside nav footer header form select html".split())
_FORMATTING = frozenset("a b big code em font i s small strike strong tt u span".split())

# What words in a class, an id or a role say about an element (fixed values).
_HINTS = {
    "content": "article content entry post story body text main hentry prose blog news page-content maincontent articlebody",
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs tabs pagination pager toc topbar skip",
    "header": "header masthead head banner logo branding hero",
    "footer": "footer foot copyright legal colophon bottom",
    "side": "sidebar aside side rail widget widgets related recommended recommend more popular trending tags tagcloud archive",
    "advert": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion promoted dfp adsense adslot commercial",
    "notice": "cookie cookies consent notice gdpr alert popup modal overlay toast message disclaimer privacy newsletter subscribe subscription signup paywall",
    "form": "form login search register contact input",
    "comments": "comment comments disqus reply replies respond discussion reviews thread",
    "share": "share sharing social follow facebook twitter",
}
_HINT_OF = {word: kind for kind, words in _HINTS.items() for word in words.split()}
#: Elements whose text is never part of a page's text.
_HIDDEN = frozenset("script style noscript template iframe svg object textarea title head select button input noframes noembed".split())

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)(?:>|\Z)|</[^>]*(?:>|\Z)""", re.S
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")


@dataclass(slots=True)
class Node:
    tag: str
    parent: int
    hints: frozenset[str]
    hidden: bool
    mark: str | None = None
    chars: int = 0
    linked: int = 0
    below: int = 0
    marks: int = 0


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(raw)}


def _hints(attributes: dict[str, str]) -> frozenset[str]:
    named = " ".join(attributes.get(a, "") for a in ("class", "id", "role", "itemprop"))
    split = re.sub(r"([a-z])([A-Z])", r"\1 \2", named).lower()
    return frozenset(_HINT_OF[w] for w in re.findall(r"[a-z]+", split) if w in _HINT_OF)


def parse(html: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """The elements in document order, and the text stream.

    The stream holds (node, text) in page order, and (node, "\\0") where a block
    begins or ends. Unclosed and crossed tags are mended as browsers do in the
    plain cases: a block closes a paragraph, an end tag closes what is open
    inside its element, and one without an element is passed over. A tag that
    the end of the page cuts off is dropped. The root stands for the body, told
    or not, so that a bare fragment is a page too.
    """
    nodes = [Node("#root", -1, frozenset(), False)]
    stream: list[tuple[int, str]] = []
    open_ = [0]
    where: dict[str, list[int]] = {}  # the places of each name in open_, so that no tag walks what is open
    position = 0

    def text(raw: str) -> None:
        if raw and not nodes[open_[-1]].hidden:
            stream.append((open_[-1], unescape(raw)))

    def pop_to(at: int) -> None:
        while len(open_) > at:
            node = nodes[open_.pop()]
            where[node.tag].pop()
            if node.tag not in _INLINE:
                stream.append((open_[-1], "\0"))

    def innermost(names: Iterable[str]) -> int:
        return max((where[n][-1] for n in names if where.get(n)), default=0)

    def close(names: Iterable[str], scope: frozenset[str]) -> None:
        at = innermost(names)
        if at and at >= innermost(scope):
            pop_to(at)

    size = len(html)
    while position < size:
        start = html.find("<", position)
        if start < 0:
            text(html[position:])
            break
        m = _TOKEN.match(html, start)
        if m is None:  # a lone sign is text
            text(html[position : start + 1])
            position = start + 1
            continue
        text(html[position:start])
        position = m.end()
        if m[2] is None or (position == size and html[-1] != ">"):
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "p" and not where.get("p"):
                stream.append((open_[-1], "\0"))
            close({tag}, frozenset() if tag not in _FORMATTING else _SCOPE)
            continue
        if nodes[open_[-1]].tag == "head" and tag not in _IN_HEAD:
            pop_to(len(open_) - 1)
        if tag == "br" or tag == "hr":
            stream.append((open_[-1], "\0" if tag == "hr" else " "))
            continue
        if tag in _VOID:
            continue
        if tag in _CLOSES_P:
            close({"p"}, _SCOPE | {"td", "th", "li"})
        if tag in _CLOSED_BY_SAME:
            close(_CLOSED_BY_SAME[tag], _SCOPE)
        attributes = _attributes(m[3])
        if tag in ("html", "body"):
            close({"head"}, frozenset())
            nodes[0].mark = attributes.get(_MARK, nodes[0].mark)
            continue
        parent = open_[-1]
        hidden = nodes[parent].hidden or tag in _HIDDEN or "hidden" in attributes or "display:none" in attributes.get("style", "").replace(" ", "").lower()
        nodes.append(Node(tag, parent, _hints(attributes), hidden, attributes.get(_MARK)))
        if tag not in _INLINE:
            stream.append((parent, "\0"))
        if m[3].rstrip().endswith("/") and tag in _RAW:
            continue
        if tag in _RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(html, position)
            body, position = (html[position : end.start()], end.end()) if end else (html[position:], size)
            if not hidden:
                stream.append((len(nodes) - 1, body))
            continue
        where.setdefault(tag, []).append(len(open_))
        open_.append(len(nodes) - 1)
    pop_to(1)
    for node, piece in stream:
        if piece != "\0":
            nodes[node].chars += len(piece.strip())
            nodes[node].marks += piece.count(".") + piece.count(",")
    for i in range(len(nodes) - 1, 0, -1):
        node, up = nodes[i], nodes[nodes[i].parent]
        node.below += node.chars
        if node.tag == "a":
            node.linked = node.below
        up.below += node.below
        up.linked += node.linked
        up.marks += node.marks
    nodes[0].below += nodes[0].chars
    return nodes, stream


def looks(node: Node) -> list[str]:
    """What speaks for or against an element, beside its name: hints, links, length, marks."""
    out = [f"hint:{h}" for h in sorted(node.hints)]
    if node.tag in _INLINE:
        return out
    share = node.linked / node.below if node.below else 0.0
    out.append(f"links:{min(3, int(share * 4))}")
    out.append(f"length:{min(6, int(math.log2(node.below / 20 + 1)))}")
    if node.below > 40:
        out.append(f"marks:{min(3, int(200 * node.marks / node.below))}")
    return out


@dataclass
class TreeModel:
    """Log potentials: of the root, of a name and label under a label, of looks.

    ``pair[tag][above][label]`` joins a child with its parent, and so does
    ``joint[look][above][label]``: links, length and marks say other things
    within content than outside of it, where a list of links is a menu. A look
    that is not in ``joint`` counts alone. Both are shares under what is known
    of the parent and the name or look, so how many lists or links there are is
    no evidence by itself. The elements right under the root have potentials of
    their own in ``top``, which count names as well: a body of paragraphs is
    content, one of parts is not.
    """

    root: list[float]
    pair: dict[str, list[list[float]]]
    looks: dict[str, tuple[float, float]]
    joint: dict[str, list[list[float]]] = field(default_factory=dict)
    top: dict[str, list[list[float]]] = field(default_factory=dict)

    def marginals(self, nodes: list[Node]) -> list[float]:
        """The probability that each element is content, by sum-product messages.

        Children come after their parents, so one pass from the last element
        sends all messages up, and one from the first sends them down.
        """
        own = [[0.0, 0.0] for _ in nodes]
        own[0] = list(self.root)
        edges = []
        for i, (node, o) in enumerate(zip(nodes, own)):
            above = self.top if self.top and not node.parent else self.pair
            edge = [list(row) for row in above.get(node.tag, above[_OTHER])]
            for look in looks(node):
                together = self.joint.get(look) if i else None
                if together is not None:
                    for y, z in _LABELS:
                        edge[y][z] += together[y][z]
                    continue
                a, b = self.looks.get(look, (0.0, 0.0))
                o[0] += a
                o[1] += b
            edges.append(edge)
        up = [[0.0, 0.0] for _ in nodes]
        for i in range(len(nodes) - 1, 0, -1):
            parent, pair = nodes[i].parent, edges[i]
            for y in (0, 1):
                up[i][y] = _log_sum(pair[y][0] + own[i][0], pair[y][1] + own[i][1])
                own[parent][y] += up[i][y]  # all that is known below the parent
        beliefs = [own[0], *[[0.0, 0.0] for _ in nodes[1:]]]
        for i in range(1, len(nodes)):
            above, pair = beliefs[nodes[i].parent], edges[i]
            rest = [above[y] - up[i][y] for y in (0, 1)]  # without what came from here
            for z in (0, 1):
                beliefs[i][z] = own[i][z] + _log_sum(rest[0] + pair[0][z], rest[1] + pair[1][z])
        return [1 / (1 + math.exp(max(-700.0, min(700.0, a - b)))) for a, b in beliefs]


_LABELS = ((0, 0), (0, 1), (1, 0), (1, 1))


def _log_sum(a: float, b: float) -> float:
    high = max(a, b)
    return high + math.log(math.exp(a - high) + math.exp(b - high))


# --- labelled pages ---------------------------------------------------------

_BOILER = frozenset("nav footer aside form".split())


def labels_of(nodes: list[Node]) -> list[int] | None:
    """Content or not for each element of a page that tells, else None.

    A marked page tells by its marks. Another tells if it has an ``article`` or
    ``main``: what lies within is content, but for menus, forms and the like
    within it, by name or by class.
    """
    marked = any(n.mark for n in nodes)
    if not marked and not any(n.tag in _MAIN for n in nodes):
        return None
    labels = [int(nodes[0].mark or 0), *[0] * (len(nodes) - 1)]
    for i, n in enumerate(nodes[1:], 1):
        if marked:
            labels[i] = int(n.mark) if n.mark in ("0", "1") else labels[n.parent]
        else:
            boiler = n.tag in _BOILER or bool(n.hints - {"content", "header"})
            labels[i] = int((labels[n.parent] or n.tag in _MAIN) and not boiler)
        labels[i] &= not n.hidden
    return labels


#: The attribute by which a rewritten page tells its labels; the model never sees it.
_MARK = "data-content"
_MAIN = ("article", "main")
_ARTICLE = re.compile(r"<(article|main)\b[^>]*>(.*?)</\1>", re.S | re.I)
_AROUND = re.compile(r"<(nav|footer|aside)\b[^>]*>(.*?)</\1>", re.S | re.I)
#: Other markups that labelled pages are rewritten to, so that the model learns
#: names and classes which the pages at hand may lack.
_CONTENT_MARKUP = ("article", "main", "div class='post-content'", "section class='entry'", "div id='story-body'", "div class='main text'")
_MENU_MARKUP = ("div class='navbar menu'", "header class='site-header'", "ul class='breadcrumbs'", "nav", "header")
_FOOTER_MARKUP = ("div class='footer'", "div id='copyright'", "footer", "section class='legal'")
_OTHER_MARKUP = (
    "div class='advert sponsored'", "aside class='sidebar'", "div class='cookie-notice'", "section id='comments'", "form class='newsletter'",
    "div class='related widget'", "div class='share social'", "ol class='comment-list'", "div class='promo banner'", "div class='popup consent'",
    "aside", "form", "div class='ad'",
)


def _element(markup: str, content: int, inner: str) -> str:
    return f"<{markup} {_MARK}='{content}'>{inner}</{markup.split()[0]}>"


def _paragraph(text: str, k: int) -> str:
    """A paragraph as it is, or with links, as a list, a quotation and the like."""
    words = text.split(" ")
    cut = len(words) // 3
    first, middle, last = (" ".join(w) for w in (words[:cut], words[cut : 2 * cut], words[2 * cut :]))
    return (
        f"<p>{text}</p>",
        f"<p>{first} <a href='x'>{middle}</a> {last}</p>",
        f"<ul><li>{first}</li><li>{middle} <em>{last}</em></li></ul>",
        f"<h2>{first[:60]}</h2><p>{middle} <span>{last}</span></p>",
        f"<blockquote><p>{first}</p>{middle}</blockquote><p><strong>{last}</strong></p>",
        f"<h3>{first[:40]}</h3><ol><li><p>{middle}</p></li><li><a href='y'>{last}</a></li></ol>",
        f"<div><p>{first}</p><pre><code>{middle}</code></pre></div><figure><figcaption>{last[:80]}</figcaption></figure>",
        f"<table><tr><th>{first[:30]}</th><td>{middle}</td></tr><tr><td>{last}</td></tr></table><p><i>{first}</i> <b>{last}</b></p>",
        f"<p><a href='x'>{text}</a></p>",
        f"<p>{first}</p><ul><li><a href='x'>{middle[:50]}</a></li><li><a href='y'>{last[:70]}</a></li></ul><p>{last}</p>",
        f"<details><summary>{first[:60]}</summary><p>{middle}</p></details><p><a href='x'>{first[:25]}</a> <a href='y'>{last[:25]}</a></p>",
        f"<dl><dt>{first[:40]}</dt><dd>{middle}</dd></dl><div><p>{last}</p></div>",
    )[k % 12]


def variants(html: str, number: int) -> Iterator[str]:
    """A labelled page as it is, and the same content in another markup.

    One rewriting in seven puts the content into the body itself.
    """
    yield html
    whole = _ARTICLE.search(html)
    if whole is None:
        return
    menu = footer = ""
    for m in _AROUND.finditer(html):
        menu, footer = menu or m[2], m[2]
    prose = re.sub(r"<[^>]*>", " ", whole[2])

    def other(k: int) -> str:
        start = (number * 7 + k * 131) % max(1, len(prose) - 200)
        text = prose[start : start + 30 + (number * 37 + k * 89) % 300]
        inner = (f"<p>{text}</p>", f"<h3>{text[:20]}</h3><p>{text}</p>", text, f"<ul><li><a href='x'>{text}</a></li></ul>", f"<div><p>{text}</p></div><label>{text[:9]}</label>")
        return _element(_OTHER_MARKUP[(number + 5 * k) % len(_OTHER_MARKUP)], 0, inner[(number // 3 + k) % len(inner)])

    places = iter(range(number, number + whole[2].count("<p>") + 1))
    content = re.sub(r"<p>([^<]*)</p>", lambda m: _paragraph(m[1], next(places)), whole[2]) + (other(3) if number % 2 else "")
    wrapped = number % 7
    if wrapped:
        content = _element(_CONTENT_MARKUP[number % len(_CONTENT_MARKUP)], 1, content)
    before = _element(_MENU_MARKUP[number % len(_MENU_MARKUP)], 0, menu) + other(0)
    after = other(1) + other(2) + _element(_FOOTER_MARKUP[number % len(_FOOTER_MARKUP)], 0, footer)
    page = f"{before}{content}{after}"
    if wrapped and number % 3:
        page = f"<div class='wrapper'>{page}</div>"
    yield f"<html><head><title>x</title></head><body {_MARK}='{int(not wrapped)}'>{page}</body></html>"


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages to counts by label: of names under a parent's label, of looks, of elements."""
    counts: Counter = Counter()
    for part in parts(batches, "html"):
        for number, t in zip(column_of(part, "number").to_pylist(), column_of(part, "html")):
            for page in variants(t.as_py(), number):
                nodes, _ = parse(page)
                labels = labels_of(nodes) or [0] * len(nodes)
                counts["root", labels[0]] += 1
                for i, n in enumerate(nodes):
                    if i:
                        counts[f"pair:{labels[n.parent]}:{n.tag}", labels[i]] += 1
                        if not n.parent:
                            counts[f"top:{labels[0]}:{n.tag}", labels[i]] += 1
                    counts["element", labels[i]] += 1
                    for look in looks(n):
                        counts[look, labels[i]] += 1
                        if i and not look.startswith("hint:"):
                            counts[f"under:{labels[n.parent]}:{look}", labels[i]] += 1
    yield pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.int32()), pa.array(counts.values(), pa.int64())], ["what", "label", "n"]
    )


def fit(pages: DataFrame, sample: int = SAMPLE) -> TreeModel:
    """Potentials from about ``sample`` labelled pages, the first by hash of html.

    Copies of a page are one page: each counts once, and they are combined
    before the shuffle.
    Counts are summed by Spark; their number depends on the names and looks
    there are, not on the pages. Without a labelled page nothing speaks for or
    against content, and all text is as likely content as not.
    """
    told = plain(pages, "html").filter(F.col("html").rlike("(?i)<(article|main)[ >]")).withColumn("page", F.xxhash64("html"))
    total = told.select("page").distinct().count()
    h = F.shiftrightunsigned("page", 32)
    chosen = told.filter(h < int((1 << 32) * min(1.0, sample / max(1, total)))).groupBy("page").agg(F.first("html").alias("html"))
    rows = chosen.select("html", (h % 9973).cast("int").alias("number"))
    counts = rows.mapInArrow(_count, "what string, label int, n bigint").groupBy("what", "label").agg(F.sum("n").alias("n")).collect()
    return potentials({(r.what, r.label): r.n for r in counts})


def potentials(counts: dict[tuple[str, int], int]) -> TreeModel:
    """Smoothed log shares of counted labels."""

    def two(what: str) -> list[float]:
        return [counts.get((what, y), 0) + _SMOOTH for y in (0, 1)]

    def logs(values: list[float], total: list[float]) -> list[float]:
        return [math.log(v / t) for v, t in zip(values, total)]

    names = {w.split(":", 2)[2] for w, _ in counts if w.startswith("pair:")} | {_OTHER}
    table = {tag: [two(f"pair:{above}:{tag}") for above in (0, 1)] for tag in names}
    pair = {tag: [logs(table[tag][above], [sum(table[tag][above])] * 2) for above in (0, 1)] for tag in names}
    first = {tag: [two(f"top:{above}:{tag}") for above in (0, 1)] for tag in names}
    under = [sum(sum(first[tag][above]) for tag in names) for above in (0, 1)]
    top = {tag: [logs(first[tag][above], [under[above]] * 2) for above in (0, 1)] for tag in names}
    kinds: dict[str, list[float]] = {"hint": two("element")}
    shown = [w for w, _ in counts if w.split(":")[0] in ("hint", "links", "length", "marks")]
    for what in set(shown):
        kind, values = what.split(":")[0], two(what)
        if kind != "hint":  # one hint may stand beside another, so its share is of all elements
            held = kinds.setdefault(kind, [0.0, 0.0])
            kinds[kind] = [held[0] + values[0], held[1] + values[1]]
    speak = {what: tuple(logs(two(what), kinds[what.split(":")[0]])) for what in set(shown)}
    # The values of one kind that were seen under either label make up the whole.
    joint = {}
    for what in {w for w in speak if not w.startswith("hint:")}:
        kind = what.split(":")[0]
        same = [w for w in speak if w.startswith(f"{kind}:")]
        whole = [[sum(two(f"under:{above}:{w}")[y] for w in same) for y in (0, 1)] for above in (0, 1)]
        seen = [two(f"under:{above}:{what}") for above in (0, 1)]
        usual = [math.log(sum(seen[above]) / sum(whole[above])) for above in (0, 1)]
        joint[what] = [[v - usual[above] for v in logs(seen[above], whole[above])] for above in (0, 1)]
    return TreeModel(logs(two("root"), [sum(two("root"))] * 2), pair, speak, joint, top)


# --- extraction -------------------------------------------------------------


def main_text(html: str | None, model: TreeModel) -> str:
    """The blocks of content in page order, joined by one space each."""
    nodes, stream = parse(html or "")
    likely = model.marginals(nodes)
    blocks, held = [], []
    for node, piece in stream:
        if piece == "\0":
            blocks.append("".join(held))
            held = []
        elif likely[node] >= 0.5:
            held.append(piece)
    blocks.append("".join(held))
    return " ".join(" ".join(b.split()) for b in blocks if not b.isspace() and b)


def extract(pages: DataFrame, model: TreeModel) -> DataFrame:
    """(page_id, url, text), one row per row of ``pages``.

    A null html counts as empty; a page without content has an empty text.
    Repeated rows are all answered; an empty table gives an empty one; extra
    columns are ignored.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for part in parts(batches, "html"):
            texts = [main_text(t.as_py(), own) for t in column_of(part, "html")]
            yield pa.RecordBatch.from_arrays(
                [column_of(part, "page_id").cast(pa.int64()), column_of(part, "url"), pa.array(texts, pa.string())], ["page_id", "url", "text"]
            )

    return plain(pages, "page_id", "url", "html").mapInArrow(run, "page_id bigint, url string, text string")
