import itertools
import random
import re
import time
from html import unescape

import numpy as np
import pytest

from wardflow.llm import crf, extract
from wardflow.llm.dom import Cues, blocks_of

SCHEMA = "page_id bigint, url string, html string, text string, id int"
PAGES = "/root/testdata/sf0.01/pages.parquet"


def texts(html):
    return [b.text for b in blocks_of(html, Cues())]


@pytest.mark.parametrize("html,expected", [
    ("", []), ("  \n", []), ("a", ["a"]), ("<", ["<"]), ("a < b & c", ["a < b & c"]),
    ("<p>a<b>b</b>c<br>d<p>e</p><ul><li>x<li>y</ul>z", ["abc d", "e", "x", "y", "z"]),
    ("<script>var t='</p>'</script>x<style>p{}</style>y<!-- z --><!-->w", ["xyw"]),
    ("<title>t</title><textarea>u", []), ("&copy; &amp &am &#x41;&#66 &nbsp;&lt;p&gt;", ["© & &am AB <p>"]),
    ("<b><p>one</b> two</p></article>three", ["one two", "three"]),
    ("<table><tr><td>1<td>2<tr><td>3</table>4", ["1", "2", "3", "4"]),
    ("<dl><dt>a<dd>b<dt>c</dl>", ["a", "b", "c"]), ("<a href='x>y'>l</a> m<a href=\"z", ["l m"]),
    ("<DIV>a</div >b<p/>c", ["a", "b", "c"]), ("<svg><text>g</text></svg>k<svg>open", ["kopen"]),
    ("a<svg/>b<noscript>n</noscript>", ["ab"]), ("x</>y</ z>w<?php ?>v<!doctype html>u", ["xywvu"]),
    ("<p>a\t \n b c</p>", ["a b c"]),
])
def test_blocks(html, expected):
    assert texts(html) == expected


def test_cues_and_links():
    cues = Cues()
    html = "<div class='siteHeader a1'><div><ul id=Menu-top><li><a href=x>on</a> off</div><p hidden>h</p>"
    first, second = blocks_of(html, cues)
    assert (first.text, first.linked, first.tag) == ("on off", 2, "li")
    assert cues.sets[first.cues] == {"t:div", "t:ul", "t:li", "k:site", "k:header", "k:a", "k:menu", "k:top"}
    assert cues.sets[second.cues] == {"t:div", "t:p", "k:site", "k:header", "k:a", "k:hidden"}
    known = Cues(frozenset({"t:ul"}))
    assert known.sets[blocks_of(html, known)[0].cues] == {"t:ul"}


def test_odd_pages_take_time_in_proportion():
    start = time.process_time()
    for html in ("<div>" * 100_000 + "x", "<a href=\"x>" * 50_000, "<svg>" * 50_000 + "x", "<!--" * 50_000,
                 "</p>" * 50_000, "<b>" * 50_000 + "</i>" * 50_000, "x " * 500_000, "&" * 300_000):
        blocks_of(html, Cues())
    assert time.process_time() - start < 20


def every_labelling(scores, model):
    out = {}
    for labels in itertools.product((0, 1), repeat=len(scores)):
        total = model[f"step:b{labels[0]}"] + model[f"step:{labels[-1]}e"]
        total += sum(s for s, y in zip(scores, labels) if y)
        total += sum(model[f"step:{a}{b}"] for a, b in zip(labels, labels[1:]))
        out[labels] = total
    return out


@pytest.mark.parametrize("seed", range(20))
def test_marginals_and_decoding_equal_brute_force(seed):
    rng = np.random.default_rng(seed)
    steps, scores = rng.normal(size=8) * 2, rng.normal(size=rng.integers(1, 8)) * 3
    model = {f"step:{n}": w for n, w in zip(crf.STEPS, steps)}
    found = every_labelling(scores, model)
    share = np.exp(np.array(list(found.values())))
    share /= share.sum()
    ones, moves = crf.marginals(scores, steps)
    labels = np.array(list(found))
    assert np.allclose(ones, share @ labels)
    for a, b in itertools.product((0, 1), repeat=2):
        expected = share @ ((labels[:, :-1] == a) & (labels[:, 1:] == b)).sum(axis=1)
        assert np.isclose(moves[2 + 2 * a + b], expected)
    assert crf.decode(scores.tolist(), model) == list(max(found, key=found.get))


def test_training_learns_transitions():
    rng = random.Random(3)
    chains = []
    for _ in range(200):
        cut = rng.randrange(1, 6)
        items = [["near"] if i == cut else ["any"] for i in range(8)]
        chains.append((items, [int(i >= cut) for i in range(8)]))
    model = crf.train(chains)
    for items, labels in chains[:20]:
        assert crf.decode([sum(model.get(f, 0) for f in item) for item in items], model) == labels
    assert crf.decode([], model) == [] and crf.train([])["step:00"] == 0


def article(html):
    inner = re.search("<article>(.*)</article>", html, re.S)[1]
    return " ".join(unescape(re.sub("<[^>]*>", " ", re.sub("</?b>", "", inner))).split())


def test_pages_not_trained_on_give_their_article(spark):
    pages = spark.read.parquet(PAGES)
    model = extract.fit(pages, "page_id", "html", sample=80)
    got = extract.extract(pages, model, "page_id", "url", "html").collect()
    expected = {r.page_id: (r.url, article(r.html)) for r in pages.collect()}
    assert len(got) == len(expected) == 250
    for r in got:
        assert (r.url, r.text) == expected[r.id] and r.n_chars == len(r.text)


@pytest.fixture(scope="module")
def drawn():
    return crf.train(extract.training_chains([]))


def test_other_markup_is_told_apart(drawn):
    extractor, rng = extract.Extractor(drawn), random.Random(99)
    right = total = 0
    for _ in range(150):
        html, labels = extract.set_anew(*extract.drawn_page(rng), rng)
        blocks = texts(html)
        main = " ".join(t for t, y in zip(blocks, labels) if y).split()
        got = " ".join(extractor.main_blocks(html)).split()
        right += 2 * len(set(main) & set(got))
        total += len(set(main)) + len(set(got))
    assert right / total > 0.97


def test_a_page_of_every_part(drawn):
    story = "This is a long paragraph, with commas, of the story that readers came for. It has two sentences."
    html = (
        "<body><div class='cookie-banner'>We use cookies. Please accept them all.</div><header><h2>Site</h2></header>"
        "<nav><ul><li><a href=/>Home</a><li><a href=/n>News</a></ul></nav><main><h1>A title of the page</h1>"
        f"<p>{story}</p><div class=ad>Buy this now, it is cheap. It is very good.</div><p>{story}</p><p>End.</p></main>"
        "<aside>Related things to read</aside><form><label>Mail</label><button>Send</button></form>"
        f"<section class=comments><p>{story}</p><p>I agree.</p></section><footer>&copy; 2020 Site</footer>")
    assert extract.Extractor(drawn).main_blocks(html) == ["A title of the page", story, story, "End."]


def test_null_empty_repeated_and_long_pages(frame):
    page = "<nav><a href=x>m</a></nav><article><h1>T</h1><p>" + "Long text, of words. " * 20_000 + "</p></article><footer>f</footer>"
    rows = [(1, "u", None, "x", 1), (2, None, "", "x", 1), (3, "u", page, "x", 1), (3, "u", page, "x", 1),
            (None, None, "<p>x", None, None)]
    df = frame(rows, SCHEMA)
    model = extract.fit(df, "page_id", "html")
    got = {(r.id, r.url, r.text, r.n_chars) for r in extract.extract(df, model, "page_id", "url", "html").collect()}
    text = "T " + " ".join(["Long text, of words."] * 20_000)
    assert {(1, "u", "", 0), (2, None, "", 0), (3, "u", text, len(text))} < got
    none = frame([], SCHEMA)
    assert extract.extract(none, extract.fit(none, "page_id", "html"), "page_id", "url", "html").count() == 0
