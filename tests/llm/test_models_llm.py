"""Byte-level BPE, toxicity and HTML extraction."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from helpers import documents, odd_rows, words
from pyspark.sql import functions as F

from rivet.llm import bpe, toxicity
from rivet.llm.html_extract import block_text, extract, main_text, marginals, parse, train
from rivet.llm.html_training import labelled_pages

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(VOCABULARY),
                             special_tokens={})


def test_bpe_matches_the_tokenizer_library(spark, reference):
    rng = random.Random(1)
    odd = ["a" * 3000, "ab" * 900 + " x", " " * 500 + "x", "\n\n  \t a's 'll !!'s''s", "日本語テキスト" * 40, "🙂🙂 zx", "\x1c\x1c a\x85b",
           "".join(rng.choices("abcdefgh", k=900)), "!" * 400 + "=" * 99, "<|endoftext|>", "½²a _a_1 ſ's'S", "x　 y "]
    rows = odd_rows() + [(900 + i, t) for i, t in enumerate(odd)]
    out = bpe.encode(documents(spark, rows), VOCABULARY, public_tokenizers.PATTERN).collect()
    want = Counter()
    for i, t, *_ in rows:
        ids = reference.encode_ordinary(t or "")
        want[(i, len(ids), " ".join(map(str, ids)), (t or "").encode())] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids"], bytes(r["decoded"])) for r in out) == want


def test_bpe_word_cache_is_bounded(reference, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 300)
    own = bpe.Encoder(bpe.read_ranks(VOCABULARY), public_tokenizers.PATTERN)
    rng = random.Random(2)
    for _ in range(5):
        texts = [words(rng, 60) for _ in range(4)]
        assert [x[1] for x in own.encode(texts)] == [" ".join(map(str, reference.encode_ordinary(t))) for t in texts]
        assert len(own.ids) <= 600


def toxic_rows(n, seed):
    rng = random.Random(seed)
    bad = ["blorgface", "snizzle", "grumptard"]
    rows = []
    for i in range(n):
        w = words(rng, rng.randint(20, 120)).split()
        label = int(rng.random() < 0.3)
        if label:
            for _ in range(max(1, len(w) // 25)):
                w[rng.randrange(len(w))] = rng.choice(bad)
        rows.append((i, " ".join(w), label))
    return rows


def test_toxicity_held_out_and_misspelt(spark):
    rows = toxic_rows(700, 3)
    df = spark.createDataFrame([(i, t, y, 1.0) for i, t, y in rows], "doc_id long, text string, label int, score double")
    model = toxicity.fit(df, df.filter("doc_id < 500"))
    got = {r["doc_id"]: r["score"] for r in toxicity.score(df, model).collect()}
    hits = [(got[i] >= 0.5) == bool(y) for i, _, y in rows if i >= 500]
    assert sum(hits) / len(hits) >= 0.95
    logits = toxicity.class_logits(*model)
    base = words(random.Random(5), 30)
    plain, typo = toxicity.score_texts([base, base + " blorrgface snizzzle"], logits)
    assert typo > plain


def test_toxicity_edge_rows(spark):
    df = documents(spark, odd_rows())
    labelled = df.withColumn("label", (F.col("doc_id") % 2).cast("int"))
    out = toxicity.score(df, toxicity.fit(df, labelled, max_rows=10)).collect()
    assert len(out) == len(odd_rows()) and all(0 <= r["score"] <= 1 for r in out)
    empty = df.filter("false")
    assert toxicity.score(empty, toxicity.fit(df, labelled.filter("false"))).collect() == []


def test_features_do_not_depend_on_pieces(monkeypatch):
    text = words(random.Random(7), 400)
    ids, share = toxicity.features(text)
    monkeypatch.setattr(toxicity, "PIECE_BYTES", 97)
    again = toxicity.features(text)
    assert (ids == again[0]).all() and np.allclose(share, again[1])


def test_html_held_out_blocks():
    model = train(labelled_pages())
    right = [(marginals(n, model)[i] >= 0.5) == bool(y[i]) for n, y in labelled_pages(120, seed=99)
             for i in range(len(n)) if not n[i].tag]
    assert sum(right) / len(right) >= 0.97


def test_marginals_are_exact():
    """Sum-product against the sum over all labellings of a small page."""
    import itertools
    import math

    model = train(labelled_pages(60))
    nodes = parse("<body><nav><a href='/'>x</a></nav><article><p>some words here</p></article></body>")
    total, on = 0.0, [0.0] * len(nodes)
    for y in itertools.product((0, 1), repeat=len(nodes) - 1):
        y = (1, *y)
        p = sum(model.edge(n, nodes[n.parent])[y[n.parent]][y[i]] + y[i] * model.ratio(n, nodes[n.parent])
                for i, n in enumerate(nodes) if i)
        total += math.exp(p)
        for i, v in enumerate(y):
            on[i] += v * math.exp(p)
    assert np.allclose(marginals(nodes, model), [v / total for v in on], atol=1e-6)


def test_html_pages(spark):
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
    <nav><ul><li><a href="/a">Home</a></li></ul></nav><div class="cookie-notice"><p>We use cookies</p></div>
    <article><h1>Title &amp; more</h1><p>First <b>bold</b> para &lt;x&gt;.<br><p>Second
      line</p><div class="ad">Buy now</div><ul><li>one<li>two</ul><form><p>Your mail</p></form></article>
    <section class="comments"><p>nice post</p></section><footer>&copy; me</footer></body></html>"""
    rows = [(1, "u", page), (2, "u", None), (3, None, ""), (None, "u", "<p>"), (5, "u", "<b<b<b<!-- x"), (5, "u", page)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))
    got = [(r["page_id"], r["text"]) for r in extract(df).collect()]
    want = "Title & more\n\nFirst bold para <x>.\n\nSecond line\n\none\n\ntwo"
    assert Counter(got)[(1, want)] == 1 and Counter(got)[(5, want)] == 1
    assert (2, "") in got and (3, "") in got and len(got) == 6
    assert extract(df.filter("false")).collect() == []


def texts_of(page):
    return [t for t in (block_text(n) for n in parse(page) if not n.tag) if t]


def test_html_hidden_is_an_attribute():
    for given in ('data-title="the hidden cost"', 'class="md:block hidden lg:flex"', "title='is hidden'",
                  'data-css="display:none"', 'title="aria-hidden=true"', 'aria-hidden="false"', "data-hidden"):
        assert texts_of(f"<article {given}><p>shown</article>") == ["shown"], given
    for given in ("hidden", 'class="x" HIDDEN', "hidden=''", "hidden=until-found", "style='color:red; display : none'",
                  'aria-hidden="true"', "aria-hidden=true id=x"):
        assert texts_of(f"<div {given}>not <p>this</p></div><p>shown</p>") == ["shown"], given


def test_html_hidden_ends_where_implied():
    """An end tag left out ends the hidden element, not the page."""
    after = "<article><p>one</p><p>two</p></article>"
    assert texts_of("<p hidden>x<div>y</div>" + after) == ["y", "one", "two"]
    assert texts_of("<p hidden>x<p>y</p>" + after) == ["y", "one", "two"]
    assert texts_of("<ul><li hidden>x<li>y<li hidden>z</ul>" + after) == ["y", "one", "two"]
    assert texts_of("<ul><li hidden>x<ul><li>z</li></ul><li>y</ul>" + after) == ["y", "one", "two"]
    assert texts_of("<dl><dt hidden>x<dd>y</dl>" + after) == ["y", "one", "two"]
    assert texts_of("<table><caption hidden>c<thead hidden><tr><th>h<tbody><tr hidden><td>x<tr><td hidden>x<td>y</table>"
                    + after) == ["y", "one", "two"]
    assert texts_of("<select><optgroup hidden><option>x<optgroup><option>y</select>" + after) == ["y", "one", "two"]
    assert texts_of("<div hidden>a<div>b</div>c<span hidden>d</span></div>" + after) == ["one", "two"]
    assert texts_of("<section><span hidden>x</section>" + after) == ["one", "two"]


def test_html_math_and_object_are_judged():
    assert texts_of("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p>") == ["so x=2 holds"]
    assert texts_of("<article><object data=a><p>instead</object><p>two</article>") == ["instead", "two"]
    model = train(labelled_pages())
    page = "<article><h1>A title</h1>" + "<p>where <math><mi>abc</mi></math> is a number of some size, as shown</p>" * 3
    assert main_text(page + "</article>", model).count("abc") == 3


def test_html_very_deep_and_long():
    model = train(labelled_pages(60))
    deep = "<div>" * 3000 + "<article><p>inside</p></article>" + "</div>" * 3000
    assert isinstance(main_text(deep, model), str)
    long = "<article>" + "".join(f"<p>para number {i} with words</p>" for i in range(5000)) + "</article>"
    assert main_text(long, model).count("\n\n") == 4999


def test_html_svg_noscript_and_template_end_where_they_end():
    article = "<article><p>One <b>short</b> line of text.</p></article>"
    for front in ('<svg class="i"/>', "<noscript>", "<template>", "<svg>", "<svg><title/><path d='M0'/></svg>",
                  "<noscript><img src=x></noscript>", "<div><noscript><img src=x></div>", "<title/>",
                  "<svg><text>drawn</text></svg>", "<template><template>in</template>out</template>",
                  "<noscript><p>never closed</noscript><svg viewBox='0 0 1 1'/>"):
        text = [block_text(n) for n in parse(front + article) if not n.tag]
        assert text == ["One short line of text."], front
    page = "<noscript>" + article + "<noscript>off</noscript><template>t</template>"
    assert [block_text(n) for n in parse(page) if not n.tag] == ["One short line of text."]
    # an element without text does not part the block around it
    assert texts_of("<p>a <svg><p>x</p></svg> b<noscript><div>y</div></noscript> c</p>") == ["a b c"]


def test_html_open_inline_elements_take_linear_time():
    import time

    n = 100_000
    pages = {"<b>" * n + "</i>" * n + "<p>end</p>": 1, "<font><b>" * n + "<p>x</p>" * n: n, "<p>x</p>" + "<b " * n: 2,
             "<dl>" + "<dd>x<i>" * n: n, "<noscript>" * n + "</noscript>" * n + "x": 1, "<svg>" * n + "x": 1}
    for page, texts in pages.items():
        began = time.process_time()
        assert sum(not node.tag for node in parse(page)) == texts
        assert time.process_time() - began < 30, page[:20]


# Page styles that the templates do not have: (html, main text by hand)
STYLES = {
    "table layout": (
        """<html><body bgcolor=white><table width=100%><tr><td colspan=2 class=masthead><a href=/>The Valley Herald</a></td></tr>
        <tr><td class=leftnav><a href=/n>News</a><br><a href=/s>Sports</a><br><a href=/w>Weather</a></td><td class=story>
        <h2>River level falls after a dry spring</h2><p>The river fell to its lowest level in a decade this week, the water board said on
        Tuesday, and farmers along the lower valley were asked to irrigate at night only.<p>Rain is expected by the weekend, but
        forecasters do not think that it will be enough to refill the two reservoirs above the town.</td></tr>
        <tr><td colspan=2 class=footer>Copyright 2003 The Valley Herald. All rights reserved.</td></tr></table></body></html>""",
        ["River level falls after a dry spring",
         "The river fell to its lowest level in a decade this week, the water board said on Tuesday, and farmers along the lower "
         "valley were asked to irrigate at night only.",
         "Rain is expected by the weekend, but forecasters do not think that it will be enough to refill the two reservoirs above "
         "the town."]),
    "utility classes": (
        """<!doctype html><html><body class="antialiased"><div class="flex items-center" role="banner"><svg class="w-4"/><a href="/">Acme</a>
        <nav class="flex gap-2"><a href="/p">Pricing</a><a href="/d">Docs</a></nav></div><main class="mx-auto max-w-2xl">
        <article class="prose"><h1 class="text-3xl">How we cut build times in half</h1><p class="mt-4">Our builds used to take forty minutes on
        a good day, and nobody on the team could say where all of that time was going.</p><h2>Measure first</h2><p class="mt-4">We wrapped every
        step in a timer, and <a href="/t">found</a> that most of the time went into copying the same files over and over.</p>
        <aside class="rounded"><p>Try Acme free for thirty days.</p></aside></article></main><footer class="border-t"><p>&copy; Acme Inc</p>
        </footer></body></html>""",
        ["How we cut build times in half",
         "Our builds used to take forty minutes on a good day, and nobody on the team could say where all of that time was going.",
         "Measure first",
         "We wrapped every step in a timer, and found that most of the time went into copying the same files over and over."]),
    "bare blog": (
        """<html><head><title>my notes</title></head><body><div id="header"><a href="/">my notes</a></div><div id="post">
        <h1>Baking bread without a scale</h1><div class="body"><p>You do not need a scale to bake good bread; a cup and some patience will
        do, and after a few loaves your hands will know the dough.</p><blockquote>Bread is slow, and that is the point.</blockquote>
        <ol><li>Mix flour, water and salt in a large bowl.</li><li>Let it rest overnight in a cool place.</li></ol></div></div>
        <div id="comments"><h3>2 comments</h3><p>Great recipe, it worked for me at the first attempt and my family loved it!</p></div>
        <div id="footer">powered by hand</div></body></html>""",
        ["Baking bread without a scale",
         "You do not need a scale to bake good bread; a cup and some patience will do, and after a few loaves your hands will know "
         "the dough.", "Bread is slow, and that is the point.", "Mix flour, water and salt in a large bowl.",
         "Let it rest overnight in a cool place."]),
}


def test_html_styles_outside_the_templates():
    """No sentence of the article is lost; of the rest, little is kept."""
    model = train(labelled_pages())
    for style, (page, want) in STYLES.items():
        got = main_text(page, model).split("\n\n")
        assert [t for t in got if t in want] == want, (style, got)
        assert len(got) <= len(want) + 1, (style, got)
