"""Labelled pages for the extraction model, built from templates.

A template is markup whose text blocks carry a mark: text that starts with
``+`` is main text, any other text is not. The templates vary how sites mark
up an article and what surrounds it; words are drawn from a fixed seed.
"""

from __future__ import annotations

import random

from rivet.llm.html_extract import Node, parse

_ARTICLE = [
    "<article>{h}{ps}</article>", "<main><article class='post'>{h}{ps}</article></main>",
    "<div id='content'><div class='article-body'>{h}{ps}</div></div>", "<main id='main'>{h}{ps}</main>",
    "<div class='entry-content'>{h}{ps}</div>", "<section class='story'>{h}<div class='text'>{ps}</div></section>",
    "<div class='content'>{h}{ps}</div>", "<article><header>{h}</header>{ps}</article>",
    "<div class='wrapper'><article itemprop='articleBody'>{h}{ps}</article></div>",
]
_HEADINGS = ["<h1>+{s}</h1>", "<h1 class='title'>+{s}</h1>", "<h2>+{s}</h2>", ""]
_PARTS = [
    "<p>+{l}</p>", "<p>+{l}</p>", "<p>+{l}</p>", "<p>+{l}</p>", "<p>+{s}</p>", "<p>+{s}</p>", "<p>+{w}</p>", "<p>+{w}</p>", "<p><b>+{l}<br><p>+{l}</p>",
    "<p>+{l} <a href='/x'>{s}</a> {l}</p>", "<h2>+{s}</h2>", "<h3>+{s}</h3>", "<blockquote><p>+{l}</p></blockquote>",
    "<ul><li>+{s}</li><li>+{l}</li></ul>", "<ol><li>+{l}</li><li>+{s}</li></ol>", "<pre>+{l}</pre>", "<div>+{l}</div>",
    "<figure><img src='a'><figcaption>+{s}</figcaption></figure>", "<table><tr><td>+{s}</td><td>+{s}</td></tr></table>",
]
_INSIDE = [  # not main text, though inside the article
    "<div class='ad'>{l}</div>", "<aside>{l}</aside>", "<div class='share'><a href='/s'>{w}</a></div>",
    "<form><p>{s}</p><button>{w}</button></form>", "<div class='advert'><p>{s}</p></div>",
    "<div class='related'><ul><li><a href='/r'>{s}</a></li></ul></div>", "<div class='newsletter'><p>{l}</p></div>",
]
_BEFORE = [
    "<nav><ul><li><a href='/a'>{w}</a></li><li><a href='/b'>{w}</a></li><li><a href='/c'>{w}</a></li></ul></nav>",
    "<header><div class='logo'>{w}</div><p>{s}</p></header>", "<header class='site-header'><h1>{w}</h1></header>",
    "<div id='menu' class='menu'><a href='/m'>{w}</a> <a href='/n'>{w}</a></div>", "<div class='ad'>{l}</div>",
    "<div class='cookie-notice'><p>{l}</p><button>{w}</button></div>", "<div class='banner notice'>{l}</div>",
    "<div class='breadcrumb'><a href='/q'>{w}</a></div>", "<form class='search'><label>{w}</label></form>",
    "<div role='navigation'><ul><li><a href='/z'>{w}</a></li></ul></div>", "<div class='notice'><p>{l}</p></div>",
    "<div class='alert'>{l}</div>", "<div role='banner'><p>{s}</p></div>", "<div class='consent' id='gdpr'>{l}</div>",
]
_AFTER = [
    "<footer>&copy; {w} &middot; {l}</footer>", "<footer><p>{s}</p><ul><li><a href='/f'>{w}</a></li></ul></footer>",
    "<div class='footer' id='footer'><p>{l}</p></div>", "<aside class='sidebar'><h3>{s}</h3><p>{l}</p></aside>",
    "<div id='sidebar'><h2>{w}</h2><ul><li><a href='/s'>{s}</a></li></ul><p>{l}</p></div>",
    "<section class='comments' id='comments'><h2>{w}</h2><div class='comment'><p>{l}</p></div><div class='comment'><p>{l}</p></div></section>",
    "<div id='comments'><ol><li class='comment'><p>{l}</p></li><li class='comment'><p>{l}</p></li></ol></div>",
    "<div class='ads sponsored'><p>{l}</p></div>", "<div class='promo'><a href='/p'>{s}</a></div>",
    "<div class='subscribe'><form><p>{s}</p></form></div>", "<div class='popup modal'><p>{l}</p></div>",
    "<div class='related-posts'><h3>{w}</h3><p><a href='/t'>{s}</a></p></div>", "<div class='disclaimer'><p>{l}</p></div>",
    "<div class='social share-buttons'><a href='/u'>{w}</a></div>", "<div class='advertisement'>{l}</div>",
    "<div class='reader-comments responses'><p>{l}</p><p>{l}</p></div>", "<div role='contentinfo'>{l}</div>",
    "<div class='widget'><p>{l}</p></div>", "<div role='complementary'><p>{l}</p></div>", "<dialog><p>{l}</p></dialog>",
]


def labelled_pages(n: int = 400, seed: int = 7) -> list[tuple[list[Node], list[int]]]:
    """(nodes, labels) of ``n`` pages; an element is content if main text is below it."""
    rng = random.Random(seed)

    def words(least: int, most: int) -> str:
        return " ".join("".join(rng.choices("abcdefghilmnoprstu", k=rng.randint(2, 9)))
                        for _ in range(rng.randint(least, most)))

    def fill(markup: str) -> str:
        for mark, least, most in (("{w}", 1, 2), ("{s}", 3, 12), ("{l}", 12, 90)):
            while mark in markup:
                markup = markup.replace(mark, words(least, most), 1)
        return markup
    out = []
    for _ in range(n):
        parts = rng.choices(_PARTS, k=rng.randint(1, 14))
        for inside in rng.sample(_INSIDE, k=rng.choice([0, 0, 1, 2])):
            parts.insert(rng.randint(0, len(parts)), inside)
        body = [*rng.sample(_BEFORE, k=rng.randint(0, 4)),
                rng.choice(_ARTICLE).replace("{h}", rng.choice(_HEADINGS)).replace("{ps}", "".join(parts)),
                *rng.sample(_AFTER, k=rng.randint(0, 4))]
        inner = "".join(body)
        if rng.random() < 0.3:
            inner = f"<div class='{rng.choice(['page', 'container', 'site', 'wrap'])}'>{inner}</div>"
        nodes = parse(fill(f"<html><head><title>{{s}}</title></head><body>{inner}</body></html>"))
        labels = [0] * len(nodes)
        for i in range(len(nodes) - 1, -1, -1):
            if not nodes[i].tag:
                labels[i] = int("".join(nodes[i].text).lstrip().startswith("+"))
            if labels[i] and nodes[i].parent >= 0:
                labels[nodes[i].parent] = 1
        labels[0] = 1
        out.append((nodes, labels))
    return out
