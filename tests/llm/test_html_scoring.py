"""Scores against a plain, slow reading of the tree; nothing of the article lost; time linear in the page."""

from __future__ import annotations

import random
import time

import pytest

from lamina.llm import html

LONG = "long text, and more, of it " * 9


def words(rng: random.Random) -> str:
    return " ".join(rng.choice(("one", "two,", "three, four", "five", "a longer piece of text")) for _ in range(rng.randint(0, 12)))


def random_page(rng: random.Random, depth: int = 0) -> str:
    parts = [words(rng)]
    for _ in range(rng.randint(1, 4)):
        tag = rng.choice(("p", "div", "div class=related", "div class=content", "article", "section", "ul", "li", "h2", "a", "b", "td", "p class=legal", "div class=ad", "nav"))
        inner = random_page(rng, depth + 1) if depth < 4 and tag not in ("a", "b") else words(rng)
        parts += [f"<{tag}>{inner}" + (f"</{tag.split()[0]}>" if rng.random() < 0.9 else ""), words(rng)]
    return "".join(parts)


def plain_choice(root: html.Node) -> list[html.Node]:
    """The rule of choose() with every sum taken anew for every node."""

    def pieces(n, linked, blocks):  # (text, in a link) below a node, with or without the blocks in it
        for c in n.children:
            if isinstance(c, str):
                yield c, linked or n.tag == "a"
            elif not c.skip and (blocks or c.tag not in html.BLOCKS):
                yield from pieces(c, linked or n.tag == "a", blocks)

    def up(n):
        return [n, *up(n.parent)] if n else []

    def density(n):
        size = sum(len(t.strip()) for t, _ in pieces(n, False, True))
        return sum(len(t.strip()) for t, a in pieces(n, False, True) if a) / size if size else 0.0

    def below(n):
        return [n, *(x for c in n.children if isinstance(c, html.Node) and not c.skip for x in below(c))] if not n.skip else []

    for n in reversed(below(root)):
        if n.doubt and not n.parent.doubt:
            n.skip = density(n) >= 0.5 or not "".join(t for t, _ in pieces(n, False, True)).strip()
    scores = {}
    for n in below(root):
        own = list(pieces(n, False, False))
        size = sum(len(t.strip()) for t, _ in own)
        if size and not n.doubt and (n.tag in html.BLOCKS or n is root):
            points = (1 + sum(t.count(",") for t, _ in own) + min(size / 100, 3)) * (1 - sum(len(t.strip()) for t, a in own if a) / size)
            for level, x in enumerate(up(n.parent if n.tag in html.PARAGRAPHS else n)[:3]):
                if x.tag in ("html", "root") and level:
                    break
                scores[x] = scores.get(x, max(x.weight, -0.5)) + points / (level + 1)
    if not scores:
        return []
    final = {n: s * (1 - density(n)) for n, s in scores.items()}
    best = next(n for n in scores if final[n] == max(final.values()))
    most = final[best]
    best = next(n for n in up(best) if n.tag not in html.ROWS)
    best = next((n for n in up(best) if n.tag in ("article", "main") and n in scores), best)
    if best.tag == "article" and best.parent is not None:
        points = {n: (scores[n] - max(n.weight, -0.5)) * (1 - density(n)) for n in best.parent.children if n in scores and n.tag == "article"}
        return [n for n in best.parent.children if n is best or n in points and not n.skip and points[n] >= max(3.0, html.SIBLING * points[best])]
    if best.parent is None or best.tag in ("body", "main"):
        return [best]
    siblings = [c for c in best.parent.children if isinstance(c, html.Node) and not c.skip and (not c.doubt or c is best)]
    full = lambda n: any(t.strip() for t, _ in pieces(n, False, True))
    return [
        n for i, n in enumerate(siblings)
        if n is best or final.get(n, 0) >= max(3.0, html.SIBLING * most) or full(n) and (n.tag in html.HEADINGS and i < siblings.index(best) or n.tag == "p" and density(n) < 0.25)
    ]


def test_choice_equals_a_plain_reading():
    rng, several = random.Random(5), 0
    html.Node.__hash__ = object.__hash__
    for _ in range(400):
        page = "<body>" + random_page(rng)
        a, b = html.parse(page), html.parse(page)
        got, want = html.choose(a), plain_choice(b)
        assert [html.blocks(n) for n in got] == [html.blocks(n) for n in want], page
        several += len(got) > 1
    assert several > 20


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<body><article><p>one, two, three</p><p class='related'>kept</p><div class='legal'>kept, too</div><div class=related><a href=x>go</a> <a href=y>there</a></div><div class=ad>buy</div></article>", "one, two, three\nkept\nkept, too"),
        ("<body><p>before</p><div><p>" + LONG + "</p></div><p>after</p></body>", "before\n" + LONG.strip() + "\nafter"),
        ("<body><div class=legal><p>" + LONG * 3 + "</p></div><div><p>" + LONG + "</p></div></body>", LONG.strip()),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
        ("<p>a <a href='x>y' title=\"it's > that\">link</a> b, c</p>", "a link b, c"),
        ("<p>a <i title=\"never closed>b</i> c</p>", "a b c"),
        ("<dl><dt>a<dd>b<dt>c<dd>d</dl>", "a\nb\nc\nd"), ("<div><p>x, y</p><svg><p>z</p></div>", "x, y\nz"), ("<p>1 < 2, and 3 > 2</p>", "1 < 2, and 3 > 2"),
    ],
)
def test_nothing_of_the_article_is_lost(page, text):
    assert html.main_text(page) == text


PROSE = "A sentence of the article that goes on for a while, with a comma or two, and tells the reader something. " * 2


@pytest.mark.parametrize(
    ("page", "text"),
    [
        # a page that one form is around, with a form of its own kind in it
        (f"<body><form action=/><div id=header>x</div><div class=content><h1>Title</h1><p>{PROSE}</p></div></form></body>", f"Title\n{PROSE.strip()}"),
        (f"<body><form><article><p>Short, text.</p></article></form></body>", "Short, text."),
        (f"<body><article><p>{PROSE}</p><form><p>Your name</p><input></form></article></body>", PROSE.strip()),
        ("<body><form><label>User</label><p>Password</p></form></body>", ""),
        # articles that follow each other
        (f"<body><article><p>{PROSE}</p></article><article><p>Two: {PROSE}</p></article><article><h2>Teaser</h2></article></body>", f"{PROSE.strip()}\nTwo: {PROSE.strip()}"),
        # words in classes that have other senses
        *[(f"<body><article><p>{PROSE}</p><{tag} {mark}>{PROSE}</{tag}></article></body>", f"{PROSE.strip()}\n{PROSE.strip()}") for tag, mark in (("p", 'class="navy-text"'), ("section", 'class="modal-verbs"'), ("p", 'class="promotion-history"'), ("p", 'class="share-of-market"'), ("p", 'id="login"'), ("section", 'id="discussion"'))],
        *[(f"<body><article><p>{PROSE}</p><div {mark}>{PROSE}</div></article></body>", PROSE.strip()) for mark in ("class=ad", "class='ad-slot top'", "class=modal", "class='newsletter-signup'", "id=comments", "class='site-nav' hidden", "class=notice")],
        (f"<body><article><p>{PROSE}</p><div class='share-buttons'><a href=a>Share it</a> <a href=b>Send it</a></div></article></body>", PROSE.strip()),
        # reader comments
        (f"<body><article><p>{PROSE}</p><ol class='commentlist'><li>{PROSE}</li></ol></article></body>", PROSE.strip()),
        (f"<body><article><p>{PROSE}</p><article class='comment-body'><p>{PROSE}</p></article></article></body>", PROSE.strip()),
        (f"<body><div class=story><p>{PROSE}</p></div><div class='discussion'><p>{PROSE}</p></div></body>", PROSE.strip()),
        (f"<body><article><p>{PROSE}</p><div class='discussion'><div>{PROSE}</div><div>{PROSE}</div></div></article></body>", PROSE.strip()),
    ],
)
def test_parts_of_the_article_and_others(page, text):
    assert html.main_text(page) == text


def test_equal_containers_give_the_first():
    assert html.main_text("<body><article><p>same, text</p></article><article><p>sane, text</p></article>") == "same, text"


@pytest.mark.parametrize("make", [lambda n: "<ul><li>" * n + "x", lambda n: '<a "' * n, lambda n: '<a x="' * n, lambda n: "<svg>" * n, lambda n: "<div>" * n + "</p>" * n + "</div>" * n, lambda n: "<center>" * n + "<li>" * n, lambda n: "<span hidden>" * n + "</b>" * n, lambda n: "<a " + 'class="' * n + ">", lambda n: "<p a" + " " * 25 * n + "/>", lambda n: "<p " + "a / " * 10 * n + ">", lambda n: "<p " + "a=' " * n + ">", lambda n: "<form>" * n + "x", lambda n: "<div>" + "<h2>a</h2>" * n + "<p>b, c"])
def test_time_is_linear(make):
    html.main_text(make(1000))
    began = time.process_time()
    html.main_text(make(40_000))
    assert time.process_time() - began < 6


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "u", "<p>a</p>", 7, 8)], "page_id long, url string, html string, n_chars long, text int")
    assert [tuple(r) for r in html.extract(df).collect()] == [(1, "u", "a", 1)]
