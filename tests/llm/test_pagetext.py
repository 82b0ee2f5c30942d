"""HTML extraction against a plain version with whole stacks and rounds, and on
pages that are long, deep or broken."""

import random
import time

import pytest

pytest.importorskip("plainweave.llm")

from plainweave.llm import pagetext as P  # noqa: E402

WORDS = "apples are red, pears are green. some say so; others do not! why not ask".split()


def chain(node):
    out = []
    while node is not None:
        out.append(node)
        node = node.above
    return out[::-1][1:]  # from the outermost element inwards


def plain_counted(found):
    """Scope by scope, the innermost first, and in each until nothing changes."""
    found = [(ns, t) for ns, t in found if not any(n.hidden or n.tag in P.OUTSIDE for n in ns)]
    articles = {id(n): ns[: k + 1] for ns, _ in found for k, n in enumerate(ns) if n.article}
    if articles:
        around = {a: sum(n.noise for n in ns) for a, ns in articles.items()}
        few = [a for a in around if around[a] == min(around.values())]
        for a in few:
            for n in articles[a]:
                n.noise = False
    scopes = sorted(articles.values(), key=len, reverse=True) if articles else [()]
    for scope in scopes:
        k = len(scope)

        def inside(nodes, scope=scope, k=k):
            return len(nodes) >= k and all(a is b for a, b in zip(scope, nodes))

        mine = [(ns[k:], t) for ns, t in found if inside(ns)]
        total = sum(len(t) for _, t in mine)
        while True:
            free = sum(len(t) for ns, t in mine if not any(n.noise for n in ns))
            sizes = {}
            for ns, t in mine:
                at = next((j for j, n in enumerate(ns) if n.noise), None)
                if at is not None and not any(n.article for n in ns[:at]):
                    sizes.setdefault(id(ns[at]), [ns[at], 0])[1] += len(t)
            wrong = [n for n, size in sizes.values() if 2 * size > total and size >= P.MOST * free]
            if not wrong:
                break
            for n in wrong:
                n.noise = False
    return [(ns, t) for ns, t in found if not any(n.noise for n in ns)]


def plain_main(page):
    _, found = P.blocks(page)
    found = plain_counted([(chain(n), t) for n, t in found])
    if not found:
        return ""
    sums = {}
    for ns, t in found:
        s = sums.setdefault(tuple(n.path for n in ns), [0, 0, 0])
        s[0], s[1], s[2] = s[0] + 1, s[1] + len(t), s[2] + len(P.PUNCTUATION.findall(t))
    own = [(s[1] / s[0]) ** 0.5 * s[1] ** 0.5 for s in sums.values()]
    length = P.smoothed(own)
    points = P.smoothed([(s[2] / s[0]) ** 0.5 * s[2] ** 0.5 for s in sums.values()])
    fused = [o * (1 + p) + a for o, a, p in zip(own, length, points)]
    limit = min(P.spread(fused), max(fused) / 2)
    good = {key for key, f in zip(sums, fused) if f >= limit and f > 0}
    is_good = [tuple(n.path for n in ns) in good for ns, _ in found]
    outer = [next(([*ns[: k + 1]] for k, n in enumerate(ns) if n.article), []) for ns, _ in found]
    held = sum(len(t) for (_, t), g, o in zip(found, is_good, outer) if g and o)
    every = sum(len(t) for (_, t), g in zip(found, is_good) if g)
    if 2 * held >= every:
        tops = {id(o[-1]): o for o, g in zip(outer, is_good) if g and o}
        within = [len(o) if o and id(o[-1]) in tops else None for o in outer]
    else:
        chosen = [ns for (ns, _), g in zip(found, is_good) if g]
        common = list(chosen[0][:-1])
        for ns in chosen:
            k = 0
            while k < min(len(common), len(ns)) and common[k] is ns[k]:
                k += 1
            common = common[:k]
        tops = {}
        within = [len(common) if len(ns) >= len(common) and all(a is b for a, b in zip(common, ns)) else None for ns, _ in found]
    holding = {id(n) for (ns, _), g in zip(found, is_good) if g for n in ns}
    kept = []
    for (ns, t), g, k in zip(found, is_good, within):
        if k is None:
            continue
        between = [n for n in ns[k:] if id(n) not in holding]
        beside = all(n.tag in P.BESIDE for n in between) and (between or (tops and len(ns) == k))
        if g or beside or (ns[k:] and ns[-1].tag == "h1"):
            kept.append(t)
    return "\n".join(kept)


def random_page(seed):
    draw = random.Random(seed)
    tags = ["div", "div", "p", "p", "article", "section", "ul", "li", "h1", "form", "nav", "blockquote", "table", "tr", "td", "main", "header", "aside"]
    names = ["", "", "", ' class="ad"', ' class="content"', ' id="sidebar"', " hidden", ' class="comments"', ' role="main"']
    out, opened = [], []
    for _ in range(draw.randint(1, 60)):
        kind = draw.random()
        if kind < 0.45:
            out.append(" ".join(draw.choices(WORDS, k=draw.choice([1, 3, 10, 40]))))
        elif kind < 0.75 or not opened:
            tag = draw.choice(tags)
            out.append(f"<{tag}{draw.choice(names)}>")
            opened.append(tag)
        elif kind < 0.9:
            out.append(f"</{opened.pop()}>")
        else:
            out.append(draw.choice(["<br>", "<span class=ad>buy</span>", "<b>bold</b>", "<i hidden>no</i>", "</p>", "</td>", "<script>x<y</script>", "<svg><text>no</text></svg>"]))
    return "".join(out)


@pytest.mark.parametrize("start", range(0, 3000, 500))
def test_as_plain(start):
    for seed in range(start, start + 500):
        page = random_page(seed)
        assert P.main_text(page) == plain_main(page), page


def test_given_pages_as_plain(spark, sf):
    for r in spark.read.parquet(f"{sf}/pages.parquet").select("html").collect():
        assert P.main_text(r["html"]) == plain_main(r["html"])


N = 20_000


@pytest.mark.parametrize(
    "page",
    [
        "<body><article>" + "<div class=ad><p>x y." * N, "<div class=sidebar>" * N + "<p>text of it." + "</div>" * N, "<div>a" * N,
        "<p>" + "<span class=ad>a" * N, "<p>" + "<span hidden>a" * N, "<p>one</p>" + "<svg>" * N + "<p>two</p>", "<article>a" * N,
        "<blockquote>" * N + "</p>" * N + "a", "<title>x" * N, "<li>a<b>c" * N, "<form>" * N + "<article>" * N + "<p>text.",
        '<a title="x>' * N, "<object>" * N + "a" + "</object>" * N, "<td>a" * N, "<!--" * N, "</div>" * N + "a", "a" * 2_000_000, "&amp;" * 200_000,
        "<" * 200_000,
    ],
)
def test_long_and_deep(page):
    begun = time.process_time()
    P.main_text(page)
    assert time.process_time() - begun < 4  # about a second


BROKEN = [
    ("<p>One text here.</p><svg><path d='x'><p>Two texts here.</p>", "One text here.\nTwo texts here."),
    ("<p>One text <math><mi>x<mo>=<mn>2 here.</p><p>Two texts here.</p>", "One text x=2 here.\nTwo texts here."),
    ("<p>One text <math><mi>x</mi></math> here.</p><p>Two texts here.</p>", "One text x here.\nTwo texts here."),
    ("<p>One text here.<svg><text>no</text></svg> and on.</p><p>Two texts here.</p>", "One text here. and on.\nTwo texts here."),
    ("<p>One text here.</p><object><object>no</object>no</object><p>Two texts here.</p>", "One text here.\nTwo texts here."),
    *[
        (f"<p>One text here.</p><{tag}><p>Two texts here.</p>", "One text here.\nTwo texts here.")
        for tag in ("object", "video", "canvas", "noscript", "template", "audio", "iframe", "title", "textarea")
    ],
    ("<p>One text here.</p><script>var a = '<p>no</p>';", "One text here."),
    ("<p>One text here.</p><!-- <p>no</p>", "One text here."),
    ("<p>One text here.</p><script>'<svg>'</script><p>Two texts here.</p></svg>", "One text here.\nTwo texts here."),
]


@pytest.mark.parametrize(("page", "text"), BROKEN)
def test_unclosed(page, text):
    assert P.main_text(page) == text


def test_any_column_names(spark):
    names = ["page", "_page", "k0", "k1", "url", "n_chars", "html_"]
    frame = spark.createDataFrame(
        [("<p>Some text here.</p>", *range(len(names))), (None, *range(len(names)))], "html string, " + ", ".join(f"{n} int" for n in names)
    )
    got = P.extract(frame).collect()
    assert [r["text"] for r in got] == ["Some text here.", ""] and [r["n_chars"] for r in got] == [15, 0]
    assert all(r["page"] == 0 and r["_page"] == 1 and r["k0"] == 2 and r["k1"] == 3 and r["html_"] == 6 for r in got)
