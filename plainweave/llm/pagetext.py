"""Main text of web pages by ratios of their tag paths.

All text of a page is gathered by root-to-leaf tag path. Each path has the
text and the punctuation its nodes hold on average; both ratios are smoothed
over neighbouring paths, fused, and paths above a threshold are content, inside
an article element too. Headings, lists and the like that stand in the article
beside content go with it. Menus and the like never count, nor do elements
named after notices, comments and so on, unless they hold the article.
"""

from __future__ import annotations

import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plainweave.llm import words as W

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*(?:>|\Z))"
    r"|([^<]+|<)",
    re.S,
)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?", re.I)
PUNCTUATION = re.compile(r"[.,;:!?…。、，！？；：¿¡]")

# Element names of HTML by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp".split())  # hold no elements
CODE = frozenset(["script", "style"])
EMBEDDED = frozenset("noscript template svg iframe object canvas audio video".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data dfn del em font i ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr img input math mfrac mi mn mo mover mroot mrow ms msqrt mstyle "
    "msub msubsup msup mtext munder munderover".split()
)
OUTSIDE = frozenset("head nav footer aside button select option menu menuitem dialog datalist".split())
DOUBTFUL = frozenset(["form", "fieldset"])
ENDS = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]), "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
}
LISTS = frozenset("ul ol dl table body article main section div".split())
LISTED = frozenset("ul ol dl table".split())
ARTICLE = frozenset(["article", "main"])
MOST = 4  # times the text beside it
BESIDE = frozenset("header hgroup h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre figure figcaption table thead tbody tr td th p".split())
NOISE = frozenset(
    "nav navbar navigation menu header masthead footer sidebar aside ad ads adv advert adverts advertisement "
    "advertising sponsor sponsored banner cookie cookies consent gdpr notice notices alert popup modal overlay promo "
    "promotion newsletter subscribe subscription signup login share sharing social related recommended breadcrumb "
    "breadcrumbs pagination pager comment comments disqus reply replies respond widget toolbar search "
    "complementary contentinfo dialog".split()
)


class Node:
    """An element of a page, with the one it is in. `path` numbers the labels
    from the root to it. `outside` says that it is no part of the text, `noise`
    that its names speak against it."""

    __slots__ = ("tag", "above", "path", "noise", "outside", "hidden", "article", "top")

    def __init__(self, tag: str, rest: str, above: "Node | None", paths: dict[tuple[int, str], int]):
        self.tag = tag
        self.above = above
        self.article = tag in ARTICLE
        self.hidden = False
        label = tag
        self.noise = tag in DOUBTFUL or (tag == "header" and not (above is not None and above.top is not None))
        if len(rest) > 1:
            for name, *values in ATTRIBUTE.findall(rest):
                name, value = name.lower(), (values[0] or values[1] or values[2]).lower()
                if name in ("class", "id", "role"):
                    if value == "main":
                        self.article = True
                    label += f".{value}" if name == "class" else ""
                    if tag not in ("html", "body", "article", "main") and NOISE.intersection(value.split()):
                        self.noise = True
                elif name == "hidden" or (name == "aria-hidden" and value == "true"):
                    self.hidden = True
                elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                    self.hidden = True
        self.outside = self.hidden or tag in OUTSIDE or (above is not None and above.outside)
        # the outermost article around
        self.top = (above.top if above is not None else None) or (self if self.article else None)
        self.path = 0 if above is None else paths.setdefault((above.path, label), len(paths) + 1)


Token = tuple[int, str, str]  # kind, text or tag name, rest of the tag
TEXT, OPEN, CLOSE = range(3)


def tokens(page: str) -> list[Token]:
    """Texts and tags in page order. Comments, scripts, styles and the like are
    left out. One that is never closed hides the rest of the page if it is a
    comment or code, as in a browser; of others only the tag is left out."""
    found: list[Token] = []
    unclosed: set[str] = set()
    at, size = 0, len(page)
    while at < size:
        token = TOKEN.match(page, at)
        at = token.end()
        plain = token.group(4)
        if plain is not None:
            found.append((TEXT, plain, ""))
        elif token.group(2) is None:
            if token.group().startswith("<![CDATA["):
                found.append((TEXT, html.escape(token.group()[9:].removesuffix("]]>")), ""))
        else:
            tag, rest = token.group(2).lower(), token.group(3)
            if token.group(1):
                found.append((CLOSE, tag, rest))
            elif tag not in RAW:
                found.append((OPEN, tag, rest))
            elif not rest.endswith("/>") and tag not in unclosed:
                end = re.compile(rf"</{re.escape(tag)}\s*(?:>|\Z)", re.I).search(page, at)
                if end:
                    at = end.end()
                elif tag in CODE:
                    break
                else:
                    unclosed.add(tag)
    return found


def closings(found: list[Token]) -> dict[int, int]:
    """Of inline and embedded elements: place of the tag that closes each."""
    opened: dict[str, list[int]] = {}
    ends: dict[int, int] = {}
    for k, (kind, tag, rest) in enumerate(found):
        if kind == TEXT or (tag not in INLINE and tag not in EMBEDDED) or tag in VOID:
            continue
        if kind == OPEN:
            if not rest.endswith("/>"):
                opened.setdefault(tag, []).append(k)
        elif opened.get(tag):
            ends[opened[tag].pop()] = k
    return ends


def blocks(page: str) -> tuple[list[Node], list[tuple[Node, str]]]:
    """All elements, each after the one it is in, and the blocks of text in page
    order with the innermost block element around them."""
    found = tokens(page)
    ends = closings(found)
    paths: dict[tuple[int, str], int] = {}
    stack = [Node("", "", None, paths)]
    nodes = list(stack)
    places: dict[str, list[int]] = {}  # of the open elements, by name
    out: list[tuple[Node, str]] = []
    text: list[str] = []
    marked, plainly = -1, False  # last token of an inline element with a name of noise; text outside such

    def close():
        nonlocal plainly
        if text:
            joined = " ".join(html.unescape("".join(text)).split())
            text.clear()
            if joined and plainly:
                out.append((stack[-1], joined))
        plainly = False

    def last(tags) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=0)

    def drop(k: int) -> None:
        """Ends all elements from place k on; the page itself, at 0, stays."""
        for node in stack[k:]:
            places[node.tag].pop()
        del stack[k:]

    k = -1
    while k + 1 < len(found):
        k += 1
        kind, tag, rest = found[k]
        if kind == TEXT:
            text.append(tag)
            plainly = plainly or (k > marked and not tag.isspace())
            continue
        if tag in EMBEDDED:
            # with all it holds, if it is closed at all
            if kind == OPEN:
                k = ends.get(k, k)
            continue
        if tag in INLINE:
            if kind == OPEN and len(rest) > 1 and k in ends:
                node = Node(tag, rest, stack[-1], {})
                # a hidden inline element is left out with its content, one with
                # a name of noise if nothing else stands in its block
                if node.hidden:
                    k = ends[k]
                elif node.noise:
                    marked = max(marked, ends[k])
            continue
        close()
        if kind == CLOSE:
            at = last((tag,))
            if at and not (tag == "p" and last(LISTS) > at):
                drop(at)
            continue
        if tag in VOID:
            continue
        if stack[-1].tag == "p":
            drop(len(stack) - 1)
        if tag in ENDS:
            at = last(ENDS[tag])
            if at and at > last(LISTED):
                drop(at)
        if not rest.endswith("/>"):
            places.setdefault(tag, []).append(len(stack))
            stack.append(Node(tag, rest, stack[-1], paths))
            nodes.append(stack[-1])
    close()
    return nodes, out


def counted(nodes: list[Node], found: list[tuple[Node, str]]) -> list[tuple[Node, str]]:
    """Blocks outside elements that their names call noise. A name does not count
    for elements around the articles that have the fewest such elements around
    them, nor for an element with most of the text of its article (of the page,
    if there is no article) if little text stands beside it: a form around the
    page, a wrapper named after its sidebar. Every element is looked at once,
    the inner ones first."""
    found = [(node, text) for node, text in found if not node.outside]
    number = {id(node): k for k, node in enumerate(nodes)}
    above = [-1 if node.above is None else number[id(node.above)] for node in nodes]
    inside = [0] * len(nodes)  # all text in the element
    for node, text in found:
        inside[number[id(node)]] += len(text)
    clean = list(inside)
    for k in range(len(nodes) - 1, 0, -1):
        inside[above[k]] += inside[k]
    articles = [k for k, node in enumerate(nodes) if node.article and inside[k]]
    deep = [0] * len(nodes)  # names of noise around
    for k, node in enumerate(nodes):
        deep[k] = (deep[above[k]] if k else 0) + node.noise
    fewest = min((deep[k] for k in articles), default=0)
    seen = [fewest == 0] * len(nodes)
    for k in articles:
        if deep[k] == fewest:
            while k and not seen[k]:
                seen[k], nodes[k].noise = True, False
                k = above[k]
    return _weighed(nodes, found, above, inside, clean, bool(articles))


def _weighed(nodes, found, above, inside, clean, any_article: bool):
    scope = [0] * len(nodes)  # the innermost article above, or the page
    outer = [0] * len(nodes)  # the innermost noise at or above
    next_: dict[tuple[int, int], list[int]] = {}  # noise by scope and by the noise it is in
    for k, node in enumerate(nodes[1:], 1):
        up = above[k]
        scope[k] = up if nodes[up].article else scope[up]
        outer[k] = outer[up]
        if node.noise:
            next_.setdefault((scope[k], outer[k]), []).append(k)
            outer[k] = k
    for k in range(len(nodes) - 1, -1, -1):
        if nodes[k].article or (k == 0 and not any_article):
            under = outer[k]
            while True:  # at most one holds more than half
                most = next((e for e in next_.get((k, under), ()) if 2 * inside[e] > inside[k] and inside[e] >= MOST * clean[k]), None)
                if most is None:
                    break
                nodes[most].noise = False
                clean[k] += clean[most]
                under = most
        if k and not nodes[k].noise:
            clean[above[k]] += clean[k]
    bad = [False] * len(nodes)
    for k, node in enumerate(nodes):
        bad[k] = node.noise or (k > 0 and bad[above[k]])
    place = {id(node): bad[k] for k, node in enumerate(nodes)}
    return [(node, text) for node, text in found if not place[id(node)]]


def smoothed(values: list[float]) -> list[float]:
    n = len(values)
    return [
        (values[max(k - 1, 0)] + 2 * values[k] + values[min(k + 1, n - 1)]) / 4 for k in range(n)
    ]


def spread(values: list[float]) -> float:
    mean = sum(values) / len(values)
    return math.sqrt(sum((v - mean) ** 2 for v in values) / len(values))


def main_text(page: str | None) -> str:
    """Blocks of the main text, joined by line breaks; empty if there is none."""
    nodes, found = blocks(page or "")
    found = counted(nodes, found)
    if not found:
        return ""
    paths: dict[int, list[float]] = {}
    for node, text in found:
        sums = paths.setdefault(node.path, [0.0, 0.0, 0.0])
        sums[0] += 1
        sums[1] += len(text)
        sums[2] += len(PUNCTUATION.findall(text))
    # ratios weighed by what the path holds, so that one long stray line
    # does not outweigh an article of many short paragraphs
    length = smoothed([math.sqrt(s[1] / s[0]) * math.sqrt(s[1]) for s in paths.values()])
    points = smoothed([math.sqrt(s[2] / s[0]) * math.sqrt(s[2]) for s in paths.values()])
    own = [math.sqrt(s[1] / s[0]) * math.sqrt(s[1]) for s in paths.values()]
    fused = [o * (1 + p) + a for o, a, p in zip(own, length, points)]
    limit = min(spread(fused) or 0.0, max(fused) / 2)
    content = {path for path, f in zip(paths, fused) if f >= limit and f > 0}
    if not content:
        return ""
    # what content stands in: the articles that hold most of it, or else the common parent
    weight: dict[int, int] = {}
    number = {id(node): k for k, node in enumerate(nodes)}
    held = [0] * len(nodes)  # blocks of content in the element
    for node, text in found:
        if node.path in content:
            top = 0 if node.top is None else number[id(node.top)]
            weight[top] = weight.get(top, 0) + len(text)
            held[number[id(node)]] += 1
    all_held = sum(held)
    first = next(number[id(node)] for node, _ in found if node.path in content)
    above = [-1 if node.above is None else number[id(node.above)] for node in nodes]
    for k in range(len(nodes) - 1, 0, -1):
        held[above[k]] += held[k]
    articles = {top for top in weight if top}
    if sum(weight[a] for a in articles) * 2 >= sum(weight.values()):
        tops = articles
    else:
        common = max(k for k in range(len(nodes)) if held[k] == all_held)  # the innermost with all of it
        tops, articles = {max(above[first], 0) if common == first else common}, set()
    # per element: whether in what content stands in, whether all between is
    # such as stands beside content, whether anything between holds no content
    # (what does is no border for what stands beside it)
    within, fits, other = [False] * len(nodes), [True] * len(nodes), [False] * len(nodes)
    for k, node in enumerate(nodes):
        if k in tops:
            within[k] = True
        elif k and within[above[k]]:
            within[k], fits[k], other[k] = True, fits[above[k]], other[above[k]]
            if not held[k]:
                fits[k], other[k] = fits[k] and node.tag in BESIDE, True
    kept = []
    for node, text in found:
        k = number[id(node)]
        if within[k]:
            beside = fits[k] and (other[k] or (articles and k in tops))
            if node.path in content or beside or (k not in tops and node.tag == "h1"):
                kept.append(text)
    return "\n".join(kept)


def extract(pages: DataFrame, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """`pages` with `out_col`, the main text, and n_chars, its code points.

    A null or empty page, or one without content, gives an empty text. Every
    page is read whole and repeated pages each get their row; an empty table
    gives an empty result; columns with the names of the new ones are replaced,
    the page itself included if it bears one.
    """
    new = (out_col, "n_chars")
    keep = [c for c in pages.columns if c not in new]
    inner = [f"k{i}" for i in range(len(keep))]
    rows = pages.select(*[F.col(c).alias(k) for c, k in zip(keep, inner)], F.col(html_col).alias("page"))

    def run(batches):
        for batch in W.slices(batches, "page"):
            texts = [main_text(p.as_py()) for p in batch.column("page")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in inner), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                [*inner, "text", "n_chars"],
            )

    schema = T.StructType([*(T.StructField(k, pages.schema[c].dataType) for c, k in zip(keep, inner)), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    made = rows.mapInArrow(run, schema)
    return made.select(*[F.col(k).alias(c) for c, k in zip(keep, inner)], F.col("text").alias(out_col), "n_chars")
