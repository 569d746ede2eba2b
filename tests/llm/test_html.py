"""HTML extraction: marginals and gradients against enumeration, markup cases, known pages, and held-out layouts."""

import html
import itertools
import random
import re

import numpy as np
import pytest

from quire.llm import html_text, html_tree

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def pages(spark):
    return [r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").orderBy("page_id").collect()]


@pytest.fixture(scope="module")
def model(pages):
    return html_tree.train(html_text.training_pages(pages[:120]), html_text.ROUNDS, html_text.PENALTY)


def random_page(rng, n):
    page = html_tree.Page()
    for i in range(n):
        up = rng.randrange(i) if i else -1
        page.parent.append(up)
        page.depth.append(page.depth[up] + 1 if i else 0)
        page.kind.append(rng.randrange(len(html_tree.KINDS)))
        page.inline.append(rng.randrange(2))
        page.flags.append(rng.randrange(1 << html_tree.FLAGS))
        page.chars.append(rng.randrange(50))
        page.marks.append(rng.randrange(3))
        page.before.append(0)
        page.label.append(rng.randrange(2))
    return page


def enumerated(forest, score, psi):
    """Weights of all states of one tree."""
    n, out = len(score), {}
    for y in itertools.product((0, 1), repeat=n):
        v = sum(score[i] for i in range(n) if y[i])
        v += sum(psi[forest.edge[i], y[forest.parent[i]], y[i]] for i in range(n) if forest.parent[i] >= 0)
        out[y] = v
    return out


def test_marginals_against_enumeration():
    rng, gen = random.Random(3), np.random.default_rng(3)
    for n in (1, 2, 5, 9, 9, 9):
        forest = html_tree.Forest([random_page(rng, n)])
        score, psi = gen.normal(0, 2, n), gen.normal(0, 2, (html_tree.EDGES, 2, 2))
        one, pair, total = html_tree.sum_product(forest, score, psi)
        states = enumerated(forest, score, psi)
        z = np.logaddexp.reduce(list(states.values()))
        assert abs(total - z) < 1e-9
        for i in range(n):
            assert abs(one[i] - sum(np.exp(v - z) for y, v in states.items() if y[i])) < 1e-9
            if forest.parent[i] >= 0:
                for s, t in itertools.product((0, 1), repeat=2):
                    p = sum(np.exp(v - z) for y, v in states.items() if y[forest.parent[i]] == s and y[i] == t)
                    assert abs(pair[i, s, t] - p) < 1e-9


def test_several_trees_at_once_and_the_gradient():
    rng, gen = random.Random(4), np.random.default_rng(4)
    pages = [random_page(rng, n) for n in (7, 1, 12)]
    forest = html_tree.Forest(pages)
    x, y = html_tree.features(forest), np.array([v for p in pages for v in p.label])
    w, psi = gen.normal(0, 1, x.shape[1]), gen.normal(0, 1, (html_tree.EDGES, 2, 2))
    value, gw, gp = html_tree.likelihood(forest, x, y, w, psi)
    alone = 0.0
    for p in pages:
        f = html_tree.Forest([p])
        alone += html_tree.sum_product(f, np.zeros(len(p.parent)), psi)[2]
    assert abs(alone - html_tree.sum_product(forest, np.zeros(len(y)), psi)[2]) < 1e-9
    for k in (0, 5, 30):
        d = np.zeros_like(w)
        d[k] = 1e-6
        assert abs((html_tree.likelihood(forest, x, y, w + d, psi)[0] - value) / 1e-6 - gw[k]) < 1e-3
    d = np.zeros_like(psi)
    d[2, 0, 1] = 1e-6
    assert abs((html_tree.likelihood(forest, x, y, w, psi + d)[0] - value) / 1e-6 - gp[2, 0, 1]) < 1e-3


def whole(text):
    page = html_tree.parse(text)
    return html_tree.text_of(page, np.ones(len(page.parent), bool))


@pytest.mark.parametrize("text, want", [
    ("<p>a<p>b", "a\nb"),
    ("<p><b>bold<br><p>next</b> more</p>", "bold\nnext more"),
    ("a &amp; b&lt;c&gt; &#233;&nbsp;&eacute; &copy", "a & b<c> é é ©"),
    ("x<script>var a='<p>no</p>';</script>y<style>p{}</style>z", "xyz"),
    ("x<SCRIPT>if (a<b) '</p>'</SCRIPT >y", "xy"),
    ("<ul><li>one<li>two <i>x</i></ul>tail", "one\ntwo x\ntail"),
    ("<div title='a > b' class=x data-y=\"</p>\">in</div>", "in"),
    ("<!-- no <p>x</p> --><!-->yes", "yes"),
    ("<table><tr><td>a<td>b<tr><td>c</table>d", "a\nb\nc\nd"),
    ("1 < 2 and 3 > 2 <", "1 < 2 and 3 > 2 <"),
    ("</p></div>stray</b>", "stray"),
    ("<a href='x>never closed", "never closed"),
    ("<p>a\n\t b  c</p>", "a b c"),
    ("<head><title>t</title><meta x></head><body>b", "b"),
    ("<head><title>t</title><body>b", "b"),
    ("<svg><text>no</text><svg></svg></svg>yes<select><option>1</select>!", "yes!"),
    ("<textarea><p>no</textarea>yes<title>no", "yes"),
    ("<p>one<span> two</span>three</p>", "one twothree"),
    ("<![CDATA[no]]>yes<?php no ?>", "yes"),
    ("", ""),
])
def test_markup(text, want):
    assert whole(text) == want


def test_odd_markup_ends():
    for text in ("<" * 5000, "<a " * 5000, "<b>" * 3000 + "x", "<p a='" * 3000, "&" * 5000, "<div" + " a=\"" * 3001, "</p>" * 5000):
        whole(text)
    assert whole("<b>" * 3000 + "x") == "x"


def known(text):
    """Main text of a given page, by its template."""
    out = []
    for part in re.split(r"</?(?:p|h1)>", re.search(r"<article>(.*)</article>", text, re.S)[1]):
        block = " ".join(html.unescape(re.sub(r"<[^>]+>", " ", part)).split())
        out += [block] if block else []
    return "\n".join(out)


def test_query_on_all_given_pages(spark):
    got = {r["page_id"]: r for r in html_text.op12_html_text(spark, SF).collect()}
    given = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(got) == len(given)
    for r in given:
        assert got[r["page_id"]]["text"] == known(r["html"])
        assert got[r["page_id"]]["n_chars"] == len(known(r["html"])) and got[r["page_id"]]["url"] == r["url"]


def test_held_out_layouts(pages, model):
    held = html_text.training_pages(pages[120:220], layouts=3, seed=99)
    forest = html_tree.Forest(held)
    chosen = model.marginals(forest) >= html_text.SURE
    truth = np.array([v for p in held for v in p.label])
    assert ((chosen == truth) * forest.chars).sum() / forest.chars.sum() > 0.98
    exact = sum(html_tree.text_of(p, chosen[a:b]) == html_tree.text_of(p, np.array(p.label) == 1)
                for p, a, b in zip(held, forest.offset[:-1], forest.offset[1:]))
    assert exact / len(held) > 0.88


SAYS = "The quick brown fox jumps over the lazy dog, and then it rests. "


@pytest.mark.parametrize("text, want", [
    (f'<body><div id="header"><h1><a href="/">My Blog</a></h1></div><div id="nav"><a href=a>Home</a> <a href=b>About</a></div>'
     f'<div id="content"><div class="post"><h2>Title</h2><p>{SAYS * 3}</p><p>Short.</p><div class="adsbygoogle">Buy shoes '
     f'now! Great deals.</div><p>{SAYS * 2}&amp; done</p></div><div class="comments"><div class="comment"><p>Anna: {SAYS}</p>'
     f'</div></div></div><div id="sidebar"><h3>Recent</h3><ul><li><a href=c>One</a></li></ul></div>'
     f'<div id="footer">Copyright us</div></body>', ["Title", SAYS * 3, "Short.", SAYS * 2 + "& done"]),
    (f'<body><div class="cookie-notice">We use cookies. <button>OK</button></div><article><h1>Title</h1><p>{SAYS * 4}</p>'
     f'<aside class="related">Read also: other.</aside><p>{SAYS}</p><form><label>Mail</label><input></form></article>'
     f'<section id="comments"><article><p>{SAYS * 3}</p></article></section></body>', ["Title", SAYS * 4, SAYS]),
    (f"<body><header>Site<nav><a href=x>A</a></nav></header><main><h1>Title</h1><p>{SAYS}</p><p>Two.</p></main>"
     "<footer>(c) us</footer></body>", ["Title", SAYS, "Two."]),
    ("<nav><a href=x>Home</a></nav>", []),
    ("", []),
])
def test_other_pages(model, text, want):
    assert html_text.extract([text], model)[0] == "\n".join(" ".join(b.split()) for b in want)


def test_odd_rows(spark, model, pages):
    long = "<article>" + f"<p>{SAYS}</p>" * 20_000 + "</article>"
    rows = [(1, "u", None, "t", 1), (2, None, "", "t", 2), (None, "v", pages[0], "t", 3), (4, "w", pages[0], "t", 4),
            (4, "w", pages[0], "t", 4), (5, "x", long, "t", 5)]
    made = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars long")
    got = html_text.main_text(made, model).collect()
    by = {(r["page_id"], r["url"]): r for r in got}
    assert len(got) == 6 and [by[k]["n_chars"] for k in ((1, "u"), (2, None))] == [0, 0]
    assert by[(None, "v")]["text"] == by[(4, "w")]["text"] == known(pages[0])
    assert by[(5, "x")]["text"] == "\n".join([SAYS.strip()] * 20_000)
    assert html_text.main_text(made.limit(0), model).collect() == []


def test_a_table_without_labelled_pages_still_gets_a_model(spark):
    made = spark.createDataFrame([(1, "u", "<div>x</div>"), (2, "u", None)], "page_id long, url string, html string")
    model = html_text.fit(made, rounds=40)
    text = f"<nav><a href=a>A</a> <a href=b>B</a></nav><article><h1>T</h1><p>{SAYS * 3}</p></article>"
    assert html_text.extract([text], model)[0] == f"T\n{(SAYS * 3).strip()}"
    html_text.fit(made.limit(0), rounds=5)
