"""Main text of web pages by a tree-structured graphical model over their elements.

Every page becomes a tree (:mod:`quire.llm.html_tree`); sum-product message passing, from the leaves up and from the root
down, gives each element's probability of being content, and the text of those that reach ``SURE`` (``UNSURE`` on a page
without any) comes out, block by block.

The model is trained once, on the driver, from labelled pages: at most ``SAMPLE_PAGES`` rows whose own markup names their
article (an ``article`` or ``main`` element with a heading or paragraphs), and of each ``LAYOUTS`` further layouts of the
same article: other containers and names, and parts that the given pages may lack (side columns, notices, forms, reader
comments, adverts within the article). What is content there is known. Without a labelled page, layouts of plain filler
text stand in. Pages of over ``SAMPLE_CHARS`` characters are left out of the sample alone; every page is extracted whole.

Defined cases: a null or empty page, or one without content, gives the empty text and 0; text without any tag is judged
like the text of a body; unclosed, stray and nested tags, and references without an end, are read much as browsers do, an unclosed quote ends with its tag; equal
pages give equal texts; ids and addresses may be null and come back as they are; an empty table gives no rows. Other
columns are not looked at. A task holds the trees of ``PAGES_AT_ONCE`` pages, or of one page that is longer.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import table, texts_of
from quire.llm.html_tree import Forest, Model, Page, parse, text_of, train

SAMPLE_PAGES = 250
SAMPLE_CHARS = 20_000
LAYOUTS = 4
ROUNDS = 150
PENALTY = 1.0
PAGES_AT_ONCE = 256
CHARS_AT_ONCE = 4_000_000
SEED = 12
SURE = 0.5
UNSURE = 0.2  # asked for on pages of which no element reaches the other: unlike those of training, but with an article

_ARTICLE = re.compile(r"<(article|main)[\s>].*?</\1\s*>", re.I | re.S)
_FILLER = ("lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore "
           "magna aliqua ut enim ad minim veniam quis nostrud").split()


# ---------------------------------------------------------------- labelled pages


def labelled(text: str) -> Page | None:
    """A page that names its article, with labels: what is in the article is content, but for parts of other kinds."""
    found = _ARTICLE.search(text)
    if found is None or len(_ARTICLE.findall(text)) > 1 or not re.search(r"<(h1|p)[\s>]", found[0], re.I):
        return None
    inner = re.sub(r"<(nav|aside|footer|form)(?=[\s>])", r'<\1 data-content="0"', found[0][1:], flags=re.I)
    name = found[1]
    return parse(f'{text[:found.start()]}<{name} data-content="1"{inner[len(name):]}{text[found.end():]}', labels=True)


def material(page: Page) -> tuple[list[str], list[str]]:
    """Blocks of a labelled page: those of its article and the others."""
    label = np.array(page.label)
    return text_of(page, label == 1).split("\n"), text_of(page, label == 0).split("\n")


class Layout:
    """One page made of given blocks, laid out at random, with labels."""

    def __init__(self, rng: random.Random, article: list[str], others: list[str]):
        self.rng = rng
        self.article = article
        self.words = [w for b in others for w in b.split()] or _FILLER
        self.blocks = others or [" ".join(_FILLER)]
        self.named = rng.random() < 0.85  # do classes say what a part is?
        self.bare = rng.random() < 0.04  # does the article stand right in the body?

    def some(self, lo: int, hi: int) -> str:
        return html.escape(" ".join(self.rng.choice(self.words) for _ in range(self.rng.randint(lo, hi))))

    def sentence(self) -> str:
        return html.escape(self.rng.choice(self.blocks)[:400])

    def box(self, tags: str, names: str, inner: str, content: int | None = 0) -> str:
        """An element that holds a part of the page: a tag that names it, or one that a class or id names."""
        rng = self.rng
        tag = rng.choice(tags.split())
        mark = "" if content is None else f' data-content="{content}"'
        if (tag in ("div", "section", "ul", "ol") and self.named) or rng.random() < 0.3 * self.named:
            name = rng.choice(names.split())
            name = rng.choice([name, f"{name}-{rng.choice(['box', 'wrap', 'inner', 'area', 'container'])}", f"site-{name}"])
            mark += f' {rng.choice(["class", "class", "id"])}="{name}"'
        if content == 0 and rng.random() < 0.05:  # shown by a script, if at all
            mark += rng.choice([" hidden", ' style="display:none"', ' aria-hidden="true"'])
        return f"<{tag}{mark}>{inner}</{tag}>"

    def links(self, lo: int, hi: int) -> str:
        items = [f'<a href="/{k}">{self.some(1, 4)}</a>' for k in range(self.rng.randint(lo, hi))]
        if self.rng.random() < 0.7:
            return "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>"
        return " | ".join(items)

    def nav(self) -> str:
        return self.box("nav nav ul div", "nav menu navbar breadcrumbs navigation", self.links(2, 9))

    def header(self) -> str:
        inner = f'<a href="/">{self.some(1, 3)}</a>' + (f"<p>{self.some(2, 8)}</p>" if self.rng.random() < 0.5 else "")
        return self.box("header header div", "header masthead top branding topbar", inner + (self.nav() if self.rng.random() < 0.3 else ""))

    def footer(self) -> str:
        inner = f"&copy; {self.some(1, 3)} &middot; {self.sentence()}"
        inner = f"<p>{inner}</p>" if self.rng.random() < 0.5 else inner
        return self.box("footer footer div", "footer copyright legal bottom", inner + (self.links(1, 5) if self.rng.random() < 0.4 else ""))

    def side(self) -> str:
        inner = f"<h3>{self.some(1, 3)}</h3>{self.links(2, 8)}" if self.rng.random() < 0.6 else f"<h4>{self.some(1, 3)}</h4><p>{self.sentence()}</p>"
        return self.box("aside aside div div", "sidebar side widget related popular trending recommended", inner)

    def ad(self) -> str:
        inner = self.rng.choice([self.sentence(), f"<p>{self.sentence()}</p>", f'<a href="/x">{self.some(3, 12)}</a>'])
        return self.box("div div div aside", "ad ads advert advertisement sponsored promo banner", inner)

    def notice(self) -> str:
        inner = f"<p>{self.sentence()}</p>" if self.rng.random() < 0.6 else self.sentence()
        return self.box("div div section dialog", "notice cookie-notice consent gdpr alert popup banner message paywall", inner + f"<button>{self.some(1, 1)}</button>")

    def form(self) -> str:
        inner = f"<label>{self.some(1, 3)}</label><input name=q>" + (f"<p>{self.sentence()}</p>" if self.rng.random() < 0.5 else "")
        form = f'<form data-content="0" action="/f">{inner}<button>{self.some(1, 1)}</button></form>'
        return form if self.rng.random() < 0.6 else self.box("div section", "newsletter subscribe search login signup", f"<h4>{self.some(1, 4)}</h4>{form}")

    def comments(self) -> str:
        one = lambda: self.rng.choice([
            f'<div class="comment"><b>{self.some(1, 2)}</b><p>{self.sentence()}</p></div>', f"<li><p>{self.sentence()}</p></li>",
            f'<article class="comment"><p>{self.sentence()}</p></article>', f"<p>{self.some(1, 2)}: {self.sentence()}</p>"])
        inner = f"<h3>{self.some(1, 2)}</h3>" + "".join(one() for _ in range(self.rng.randint(1, 6)))
        was, self.named = self.named, True  # nothing else tells a reader's words from the writer's
        try:
            return self.box("section div div ol", "comments comment-list responses discussion replies disqus reader-comments", inner)
        finally:
            self.named = was

    def inlined(self, text: str) -> str:
        words = text.split(" ")
        if len(words) > 4 and self.rng.random() < 0.4:
            at, size = self.rng.randrange(len(words) - 2), self.rng.randint(1, 3)
            tag = self.rng.choice(["b", "em", "a", "span", "strong", "i", "code"])
            mark = ' href="/z"' if tag == "a" else ""
            return " ".join(map(html.escape, words[:at])) + f" <{tag}{mark}>" + html.escape(" ".join(words[at:at + size])) + f"</{tag}> " + " ".join(map(html.escape, words[at + size:]))
        return html.escape(text)

    def main(self) -> str:
        rng, parts = self.rng, []
        for k, text in enumerate(self.article):
            if k == 0:
                parts.append(f"<h1>{html.escape(text)}</h1>" if rng.random() < 0.8 else f"<h2>{html.escape(text)}</h2>")
                continue
            kind = rng.random()
            if kind < 0.7:
                parts.append(f"<p>{self.inlined(text)}" + ("</p>" if rng.random() < 0.9 else ""))
            elif kind < 0.82:
                parts.append(f"<h{rng.randint(2, 4)}>{html.escape(' '.join(text.split()[:6]))}</h2><p>{self.inlined(text)}</p>")
            elif kind < 0.86:
                words = text.split()
                cut = max(1, len(words) // 3)
                parts.append("<ul>" + "".join(f"<li>{html.escape(' '.join(words[i:i + cut]))}</li>" for i in range(0, len(words), cut)) + "</ul>")
            elif kind < 0.9:
                parts.append(f"<blockquote><p>{html.escape(text)}</p></blockquote>" if rng.random() < 0.5 else f"<pre>{html.escape(text)}</pre>")
            elif kind < 0.93:
                parts.append("<table><tr>" + "".join(f"<td>{html.escape(w)}</td>" for w in text.split()[:6]) + f"</tr></table><p>{html.escape(text)}</p>")
            else:
                parts.append(f"<div>{html.escape(text)}</div>")
            if rng.random() < 0.06:
                parts.append(rng.choice([self.ad, self.side, self.form, self.notice])())
        if rng.random() < 0.3:  # a section of its own within the article
            at = rng.randrange(len(parts) + 1)
            parts = [*parts[:at], "<section>" if (wrap := rng.random() < 0.5) else "<div>", *parts[at:], "</section>" if wrap else "</div>"]
        if rng.random() < 0.2:
            parts.append(self.comments())
        inner = "".join(parts)
        if self.bare:
            return inner
        root = rng.choice(["article", "main", "both", "div", "div", "section", "table"])
        if root == "both":
            return f'<main data-content="1"><article>{inner}</article></main>'
        if root == "table":
            return f'<table><tr><td data-content="1">{inner}</td></tr></table>'
        return self.box(root, "content article post entry story main-content post-body text article-body", inner, 1)

    def page(self) -> Page:
        rng = self.rng
        if rng.random() < 0.03:  # no markup at all
            page = parse(html.escape(" ".join(self.article)), labels=True)
            page.label = [1] * len(page.label)
            return page
        before = [f() for f, p in ((self.header, 0.5), (self.nav, 0.7), (self.notice, 0.4), (self.ad, 0.4), (self.form, 0.15)) if rng.random() < p]
        after = [f() for f, p in ((self.comments, 0.35), (self.side, 0.4), (self.ad, 0.2), (self.form, 0.3), (self.notice, 0.15)) if rng.random() < p]
        rng.shuffle(before)
        rng.shuffle(after)
        main = self.main()
        for _ in range(0 if self.bare else rng.choice([0, 0, 1, 2, 3])):  # columns and the like, whose names say nothing
            name = rng.choice(["", "", ' class="col"', ' class="row"', ' class="grid"', ' class="left"', ' id="main"'])
            main = f"<div{name}>{main}</div>"
        body = [main]
        if rng.random() < 0.4:
            body.insert(rng.randrange(2), self.side())
        inner = "".join(body)
        if not self.bare and rng.random() < 0.4:
            inner = self.box("div", "page wrapper container layout row", inner, None)
        foot = self.footer() if rng.random() < 0.8 else ""
        body = f'<body data-content="{int(self.bare)}">{"".join(before)}{inner}{"".join(after)}{foot}</body>'
        return parse(f"<!DOCTYPE html><html><head><title>x</title></head>{body}</html>", labels=True)


def training_pages(texts: list[str], layouts: int = LAYOUTS, seed: int = SEED) -> list[Page]:
    """Labelled pages among the given ones, and further layouts of their articles."""
    rng = random.Random(seed)
    own = [p for p in map(labelled, texts) if p is not None]
    parts = [material(p) for p in own] or [
        ([" ".join(rng.choices(_FILLER, k=rng.randint(3, 60))) + "." for _ in range(rng.randint(3, 12))], []) for _ in range(60)]
    out = list(own)
    for k, (article, others) in enumerate(parts):
        others = others + parts[(k + 1) % len(parts)][0]  # readers, notices and adverts speak in sentences too
        out += [Layout(rng, article, [b for b in others if b]).page() for _ in range(layouts)]
    return out


def fit(pages: DataFrame, html_column: str = "html", sample: int = SAMPLE_PAGES, rounds: int = ROUNDS) -> Model:
    """The model, from a bounded sample of ``pages``. At most ``2 * sample`` rows reach the driver."""
    text = F.col(html_column)
    total = pages.count()  # from the files' footers
    share = min(1.0, sample / max(total, 1))
    drawn = F.pmod(F.xxhash64(F.lit(SEED), F.monotonically_increasing_id()), F.lit(1_000_000)) < int(share * 1_000_000) + 1
    some = pages.select(text.alias("html")).filter(drawn & (F.length("html") <= SAMPLE_CHARS)).limit(2 * sample)
    return train(training_pages(sorted(r["html"] for r in some.collect())), rounds, PENALTY)


# ---------------------------------------------------------------- extraction


def extract(texts: list[str], model: Model) -> list[str]:
    """Main texts of some pages."""
    pages = [parse(t) for t in texts]
    forest = Forest(pages)
    likely = model.marginals(forest)
    out = []
    for page, lo, hi in zip(pages, forest.offset[:-1], forest.offset[1:]):
        own = likely[lo:hi]
        out.append(text_of(page, own >= (SURE if own.max() >= SURE else UNSURE)))
    return out


def _parts(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Pages of a batch, some at a time."""
    for lo in range(0, len(column), PAGES_AT_ONCE):
        part, size, start = [], 0, lo
        for text in texts_of(column.slice(lo, PAGES_AT_ONCE)):
            if part and size + len(text) > CHARS_AT_ONCE:
                yield start, part
                start, part, size = start + len(part), [], 0
            part.append(text)
            size += len(text)
        if part:
            yield start, part


def main_text(pages: DataFrame, model: Model, keep: tuple[str, ...] = ("page_id", "url"), html_column: str = "html") -> DataFrame:
    """``keep`` columns, ``text`` and ``n_chars`` of every row. ``keep`` must not name ``text`` or ``n_chars``."""
    rows = pages.select(*keep, F.col(html_column).cast("string").alias("__html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, texts in _parts(batch.column(len(keep))):
                out = extract(texts, model)
                kept = [batch.column(k).slice(lo, len(texts)) for k in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())],
                                                 [*keep, "text", "n_chars"])

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    return rows.mapInArrow(run, ", ".join([*kinds, "text string", "n_chars long"]))


def op12_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages")
    return main_text(pages, fit(pages))


QUERIES = {"op12_html_text": op12_html_text}
SQL: dict[str, str] = {}  # a trained model; tested by brute-force marginals and held-out accuracy
