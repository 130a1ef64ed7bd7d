"""Main text of HTML pages by a conditional random field over leaf blocks.

A page is the chain of its leaf blocks (``dom``). A block's features are the cues around
it (tags, words of class, id and role), its own tag, and its text: number of words, share
of linked characters, closing punctuation, sentence marks, digits, and its place. Labels
are decoded by Viterbi; the blocks of the main text, in order, are the result.

The field is trained on labelled pages:

* Pages of the table whose markup says what is what: blocks inside ``article`` or ``main``
  are main text, unless something inside it says otherwise (``APART``). At most ``SAMPLE``
  pages are taken, the first in the order of a hash of their ids.
* The same blocks set anew, with their labels, in other markup: main text in containers of
  many names or none, and menus, headers, footers, sidebars, notices, adverts, forms and
  comments around and in it. So the field learns to weigh several cues, and a table
  of one layout does not teach it that layout alone.
* ``DRAWN`` pages of drawn words set in the same way, for tables that say little.

The sample is trained on in one task, which is what the bound is for; extraction reads
every page whole, where it is.

Defined results: null and empty pages have an empty text, as have pages without main text.
Character references are decoded as in HTML, also those without a semicolon. White space
inside a block is one space. Repeated rows are extracted alike; null ids and addresses
stay null. An empty table has no pages.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from html import escape

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wardflow.llm import crf
from wardflow.llm.common import pieces, ship
from wardflow.llm.dom import LATER_SETS, Block, Cues, blocks_of

SAMPLE = 400
DRAWN = 120
REPEATS, VARIANTS = 3, 1

MAIN_TAGS = frozenset(("t:article", "t:main"))
# Cues of what is not main text, wherever it stands.
APART = frozenset((
    "t:nav t:header t:footer t:aside t:form t:dialog t:menu t:button t:label k:nav k:menu k:ad k:ads k:advert "
    "k:sidebar k:footer k:comment k:comments k:cookie k:notice k:share k:related k:promo k:hidden"
).split())

# How the parts of a page are marked up: (tag, attributes).
MAIN = (
    ("article", ""), ("article", 'class="post"'), ("main", ""), ("main", 'id="main"'), ("div", 'class="content"'),
    ("div", 'id="content"'), ("div", 'class="article-body"'), ("div", 'class="post-content"'),
    ("div", 'class="entry-content"'), ("div", 'id="main-content"'), ("section", 'class="story"'),
    ("div", 'class="text"'), ("div", 'role="main"'), ("td", 'class="body"'), ("div", ""), ("section", ""),
)
PARTS = {
    "menu": (("nav", ""), ("nav", 'class="menu"'), ("div", 'class="menu"'), ("ul", 'class="nav"'),
             ("div", 'id="navigation"'), ("div", 'class="navbar"'), ("div", 'class="breadcrumbs"'),
             ("ul", 'class="menu"'), ("div", 'role="navigation"'), ("menu", ""), ("div", 'class="toc"')),
    "header": (("header", ""), ("div", 'class="header"'), ("div", 'id="masthead"'), ("div", 'class="site-header"'),
               ("header", 'class="top"'), ("div", 'role="banner"'), ("div", 'class="top-bar"')),
    "footer": (("footer", ""), ("div", 'class="footer"'), ("div", 'id="footer"'), ("div", 'class="site-footer"'),
               ("div", 'id="colophon"'), ("footer", 'class="bottom"'), ("div", 'class="copyright"')),
    "sidebar": (("aside", ""), ("div", 'class="sidebar"'), ("div", 'id="sidebar"'), ("div", 'class="related"'),
                ("div", 'class="widget"'), ("aside", 'class="links"'), ("div", 'class="side"'),
                ("section", 'class="recommended"'), ("div", 'class="trending"')),
    "notice": (("div", 'class="cookie-notice"'), ("div", 'class="notice"'), ("div", 'id="cookies"'),
               ("div", 'class="alert"'), ("div", 'class="banner"'), ("div", 'class="consent"'), ("dialog", ""),
               ("div", 'role="alert"'), ("div", 'class="popup"'), ("div", 'id="gdpr"'), ("div", 'class="modal"')),
    "advert": (("div", 'class="ad"'), ("div", 'class="ads"'), ("div", 'class="advert"'), ("div", 'id="ad-top"'),
               ("div", 'class="advertisement"'), ("div", 'class="sponsored"'), ("div", 'class="promo"'),
               ("aside", 'class="ad"'), ("section", 'class="sponsor"'), ("ins", 'class="ad"')),
    "form": (("form", ""), ("form", 'class="search"'), ("form", 'id="newsletter"'), ("div", 'class="newsletter"'),
             ("div", 'class="subscribe"'), ("div", 'class="login"'), ("form", 'class="contact-form"')),
    "comments": (("section", 'class="comments"'), ("div", 'id="comments"'), ("div", 'class="comments"'),
                 ("ol", 'class="comment-list"'), ("div", 'class="comment"'), ("div", 'class="responses"'),
                 ("div", 'class="discussion"'), ("section", 'id="reviews"'), ("div", 'class="replies"')),
}
WRAPPERS = (("", ""), ("div", 'id="page"'), ("div", 'class="wrapper"'), ("div", 'class="container"'), ("div", ""))


# --- Features -----------------------------------------------------------------

MARKS = re.compile(r"[.!?。！？][\"'”’»)]*(?:\s|\Z)")


def steps_of(value: float, *limits: float) -> int:
    return sum(value >= limit for limit in limits)


def text_features(block: Block, place: int, count: int) -> list[str]:
    """Features of a block's own tag, text and place."""
    text = block.text
    words = text.count(" ") + 1
    size = steps_of(words, 2, 4, 8, 15, 30, 60, 150)
    linked = steps_of(block.linked / len(text), 0.01, 0.34, 0.67)
    ended = int(text[-1] in ".!?:;。！？")
    marks = steps_of(len(MARKS.findall(text[:2000])), 1, 2, 4)
    digits = steps_of(sum(map(text[:2000].count, "0123456789")) / min(len(text), 2000), 0.01, 0.1)
    return [
        f"own:{block.tag}", f"size:{size}", f"linked:{linked}", f"size-linked:{size},{linked}",
        f"ended:{ended}", f"marks:{marks}", f"size-ended:{size},{ended}", f"digits:{digits}",
        f"sign:{int('©' in text)}", f"own-size:{block.tag},{size}",
        f"place:{steps_of(place / count, 0.1, 0.35, 0.65, 0.9)}", f"first:{int(place == 0)}",
        f"last:{int(place == count - 1)}", "any",
    ]


def features(page: list[Block], cues: Cues) -> list[list[str]]:
    return [
        [*cues.sets[block.cues], *text_features(block, i, len(page))]
        for i, block in enumerate(page)
    ]


# --- Labelled pages -----------------------------------------------------------


def labelled(html: str, cues: Cues) -> tuple[list[Block], list[int]] | None:
    """Blocks and labels of a page whose markup says which is its main text."""
    page = blocks_of(html, cues)
    found = [int(bool(cues.sets[b.cues] & MAIN_TAGS) and not cues.sets[b.cues] & APART) for b in page]
    return (page, found) if any(found) else None


def element(part: tuple[str, str], inner: str) -> str:
    tag, attributes = part
    return f"<{tag}{' ' * bool(attributes)}{attributes}>{inner}</{tag}>" if tag else inner


def set_anew(main: list[tuple[str, str]], other: list[str], rng: random.Random) -> tuple[str, list[int]]:
    """A page in drawn markup, with the label of each of its blocks.

    ``main`` has (tag, text) of the main text; ``other`` are texts for everything around it.
    """
    def few(low: int, high: int) -> list[str]:
        return [rng.choice(other) for _ in range(rng.randint(low, high))]

    def part(kind: str) -> tuple[str, list[int]]:
        outer = rng.choice(PARTS[kind])
        texts = few(1, 3)
        if kind == "menu" or (kind in ("sidebar", "footer", "header") and rng.random() < 0.5):
            texts = [" ".join(t.split()[:rng.randint(1, 4)]) for t in few(2, 8)]
            items = "".join(f'<li><a href="#">{escape(t)}</a></li>' for t in texts)
            return element(outer, items if outer[0] in ("ul", "menu") else f"<ul>{items}</ul>"), [0] * len(texts)
        if kind == "form":
            texts = [" ".join(t.split()[:rng.randint(1, 5)]) for t in texts]
            rows = "".join(f"<label>{escape(t)}</label><input>" for t in texts)
            return element(outer, rows + "<button>Ok</button>"), [0] * (len(texts) + 1)
        if kind == "comments":
            texts += [rng.choice(main)[1] for _ in range(rng.randint(1, 4))]
            inner = rng.choice(("p", "div", "li"))
            return element(outer, "".join(element((inner, ""), escape(t)) for t in texts)), [0] * len(texts)
        if rng.random() < 0.25:
            texts.append(rng.choice(main)[1])
        if len(texts) == 1 and rng.random() < 0.6:
            return element(outer, escape(texts[0])), [0]
        return element(outer, "".join(f"<p>{escape(t)}</p>" for t in texts)), [0] * len(texts)

    body, labels = "", []

    def add(kind: str, chance: float) -> None:
        nonlocal body
        if rng.random() < chance:
            inner, found = part(kind)
            body += inner
            labels.extend(found)

    add("notice", 0.3)
    add("header", 0.5)
    add("menu", 0.8)
    add("advert", 0.5)
    add("sidebar", 0.25)
    inner, inside = "", []
    cut = rng.randrange(len(main) + 1) if rng.random() < 0.35 else -1
    for i, (tag, text) in enumerate(main):
        if i == cut:
            extra, found = part(rng.choice(("advert", "sidebar", "notice", "form")))
            inner += extra
            inside += found
        inner += element((tag, ""), escape(text))
        inside.append(1)
    if rng.random() < 0.2:
        extra, found = part("comments")
        inner += extra
        inside += found
    body += element(rng.choice(MAIN), inner)
    labels += inside
    add("comments", 0.35)
    add("sidebar", 0.35)
    add("advert", 0.3)
    add("form", 0.4)
    add("footer", 0.85)
    return f"<html><body>{element(rng.choice(WRAPPERS), body)}</body></html>", labels


def drawn_page(rng: random.Random) -> tuple[list[tuple[str, str]], list[str]]:
    """Main text and other texts of drawn words."""
    def words(n: int) -> str:
        found = ["".join(rng.choice("aeiou") + rng.choice("lmnrstdk") for _ in range(rng.randint(1, 3))) for _ in range(n)]
        return " ".join(found).capitalize()

    main = [("h1", words(rng.randint(2, 8)))]
    for _ in range(rng.randint(1, 12)):
        size = rng.choice((1, 3, 8, 25, 60, 120))
        main.append((rng.choice(("p", "p", "p", "p", "h2", "li", "blockquote")), words(size) + rng.choice((".", ".", ""))))
    return main, [words(rng.randint(1, 12)) + rng.choice(("", ".", "")) for _ in range(12)]


def training_chains(pages: list[str], seed: int = 7) -> list[tuple[list[list[str]], list[int]]]:
    """Feature chains and labels of labelled pages, as they are and set anew."""
    rng = random.Random(seed)
    cues, chains, texts = Cues(), [], []
    for html in pages:
        found = labelled(html, cues)
        if found is None:
            continue
        page, labels = found
        chains += [(features(page, cues), labels)] * REPEATS
        main = [(b.tag if b.tag not in ("html", "body") else "p", b.text) for b, y in zip(page, labels) if y]
        texts.append((main, [b.text for b, y in zip(page, labels) if not y] or ["Menu"]))
    # Texts of the page alone would make its menu words a cue.
    texts = texts * VARIANTS + [drawn_page(rng) for _ in range(DRAWN)]
    for main, other in texts:
        html, labels = set_anew(main, other, rng)
        page = blocks_of(html, cues)
        if len(page) == len(labels):
            chains.append((features(page, cues), labels))
    return chains


def _fit_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pages = [html for batch in batches for html in batch.column("html").to_pylist()]
    model = crf.train(training_chains(pages))
    yield pa.record_batch(
        [pa.array(list(model)), pa.array(list(model.values()), pa.float64())], names=["name", "weight"])


def fit(pages: DataFrame, id_col: str, html_col: str, sample: int = SAMPLE) -> crf.Model:
    """Weights of a field trained on at most ``sample`` labelled pages of the table."""
    ship(pages.sparkSession)
    rows = pages.select(
        F.xxhash64(F.col(id_col).cast("string")).alias("draw"),
        F.col(html_col).cast("string").alias("html"))
    marked = rows.where(F.col("html").rlike("(?i)<(article|main)[\\s>]"))
    some = marked.orderBy("draw", F.length("html"), F.xxhash64("html")).limit(sample).select("html")
    found = some.coalesce(1).mapInArrow(_fit_batches, "name string, weight double").collect()
    # Features are tags, words of names and a few classes of texts: some thousand.
    return {row["name"]: row["weight"] for row in found}


# --- Extraction ---------------------------------------------------------------


class Extractor:
    """Decodes pages with one model; what sets of cues weigh is remembered."""

    def __init__(self, model: crf.Model):
        self.model = model
        self.cues = Cues(frozenset(n for n in model if n[:2] in ("t:", "k:")))
        self.around: dict[int, float] = {}

    def main_blocks(self, html: str) -> list[str]:
        """Texts of the blocks of the main text, in order."""
        if len(self.cues.steps) > LATER_SETS:
            self.cues.clear()
            self.around.clear()
        get, around = self.model.get, self.around
        page = blocks_of(html, self.cues)
        scores = []
        for i, block in enumerate(page):
            known = around.get(block.cues)
            if known is None:
                known = around[block.cues] = sum(
                    get(c, 0.0) for c in sorted(self.cues.sets[block.cues]))
            scores.append(known + sum([get(f, 0.0) for f in text_features(block, i, len(page))]))
        labels = crf.decode(scores, self.model)
        return [block.text for block, label in zip(page, labels) if label]


_extractors: list[Extractor] = []


def extractor_of(model: crf.Model) -> Extractor:
    """This worker's extractor, if the model is the one it has seen last."""
    if not _extractors or _extractors[0].model is not model:
        _extractors[:] = [Extractor(model)]
    return _extractors[0]


def _extract_batches(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extractor = extractor_of(shared.value)
        for batch in batches:
            for part in pieces(batch, "html"):
                texts = [" ".join(extractor.main_blocks(h or "")) for h in part.column("html").to_pylist()]
                yield pa.record_batch(
                    [part.column("id"), part.column("url"), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())],
                    names=["id", "url", "text", "n_chars"])

    return run


def extract(pages: DataFrame, model: crf.Model, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """Columns id, url, text, n_chars of every page."""
    spark = pages.sparkSession
    ship(spark)
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(url_col).cast("string").alias("url"),
        F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(
        _extract_batches(spark.sparkContext.broadcast(model)),
        "id bigint, url string, text string, n_chars bigint")
