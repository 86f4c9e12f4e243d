"""HTML extraction against an independent parser on the given pages, and on other layouts."""

import html
from html.parser import HTMLParser

import numpy as np
import pytest
from marquetry.llm import html_extraction as H

BREAKS = set("p br h1 div article li ul nav footer body html head".split())


class Article(HTMLParser):
    """The text inside <article>; every block-level tag is white space."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.parts = False, []

    def handle_starttag(self, tag, attrs):
        self.inside |= tag == "article"
        if tag in BREAKS:
            self.parts.append(" ")

    def handle_endtag(self, tag):
        if tag == "article":
            self.inside = False
        if tag in BREAKS:
            self.parts.append(" ")

    def handle_data(self, data):
        if self.inside:
            self.parts.append(data)


@pytest.fixture(scope="module")
def model(spark):
    return H.fitted(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"), 120)


def test_given_pages(spark, model):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    sources = {r.page_id: r.html for r in pages.collect()}
    got = H.extract(pages, model).collect()
    assert len(got) == len(sources)
    for r in got:
        page = sources[r.page_id]
        whole = page.rstrip().endswith("</html>")
        parser = Article()
        parser.feed(page)
        if whole:
            parser.close()
            assert r.text == " ".join("".join(parser.parts).split())
        else:
            assert r.text.startswith(" ".join("".join(parser.parts).split())[:-40])
        assert r.n_chars == len(r.text)


def test_other_layouts(model):
    import random

    rng = random.Random(5)
    words = "the of and to in is that for with on as are this be by from at have it".split()
    line = lambda n: " ".join(rng.choices(words, k=n))
    wrong = total = 0
    for _ in range(60):
        blocks = H.blocks_of(H._rebuilt(rng, [line(40) for _ in range(rng.randint(2, 12))], [line(8) for _ in range(20)]))
        (scores,) = model.scores([H.vectors([blocks])])
        labels = np.array([H.taught(b[0]) for b in blocks])
        wrong, total = wrong + int(((scores > 0) != labels).sum()), total + len(blocks)
    assert wrong <= 0.01 * total


def test_blocks():
    page = """<title>no</title><p>a<b>b</b> &amp;&nbsp;c<br>d<p>e<script>if (a<b) "</p>"</script>f<ul><li>x<li>y</ul><div class='Side-Bar'>z<!-- <p>no -->"""
    got = H.blocks_of(page)
    assert [b[1] for b in got] == ["ab & c d", "e", "f", "x", "y", "z"] or [b[1] for b in got] == ["ab & c d", "ef", "x", "y", "z"]
    assert got[-1][0] == (("div", "side", "bar"),)
    assert [b[1] for b in H.blocks_of("a &am")] == ["a &am"] and [b[1] for b in H.blocks_of('x < y <a href="/un')] == ["x < y"]
    assert H.blocks_of("") == [] and H.blocks_of("<p") == [] and H.blocks_of("<!-- open") == []


def test_odd_pages(spark, model):
    rows = [(1, None, None, "t"), (2, "u", "", "t"), (2, "u", "", "t"), (3, "u", "plain words", "t"), (None, "u", "<article>" + "<p>long words here.</p>" * 5000 + "</article>", "t")]
    got = H.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string"), model).collect()
    assert len(got) == 5 and [r.text for r in got if r.page_id in (1, 2)] == ["", "", ""]
    assert next(r for r in got if r.page_id is None).text == " ".join(["long words here."] * 5000)
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert H.extract(empty, H.fitted(empty)).collect() == []


def test_gradients():
    rng = np.random.default_rng(0)
    model = H.Labeller()
    x, mask = rng.normal(size=(4, 3, H.FEATURES)).astype(np.float32), np.array([[1, 1, 1], [1, 1, 0], [1, 0, 0], [1, 0, 0]], bool)
    weight = rng.normal(size=(4, 3, H.HIDDEN)).astype(np.float32)
    kept = []
    model.left.forward(x, mask, kept)
    grads = model.left.backward(x, mask, kept, weight)
    for p, g in zip(model.left.p, grads):
        at = np.unravel_index(int(np.abs(g).argmax()), g.shape)
        value = p[at]
        p[at] = value + 1e-2
        up = (model.left.forward(x, mask) * weight).sum()
        p[at] = value - 1e-2
        down = (model.left.forward(x, mask) * weight).sum()
        p[at] = value
        assert np.isclose((up - down) / 2e-2, g[at], rtol=0.05)


def test_entities_match_the_standard():
    assert H.blocks_of("<p>&copy; &#233;&notit;")[0][1] == html.unescape("&copy; &#233;&notit;")


def test_layouts_without_telling_names(model):
    """No name of this page says what is main text: containers are plain, names are drawn."""
    import random

    rng = random.Random(8)
    sentences = [" ".join(rng.choices("the river runs past old houses where people sit in summer and talk about rain".split(), k=rng.randint(8, 40))).capitalize() + "." for _ in range(200)]
    wrong = total = positive = 0
    for _ in range(80):
        page = H._rebuilt(rng, rng.sample(sentences, rng.randint(3, 15)), [s[:60] for s in sentences])
        labels = np.array([H.taught(b[0]) for b in H.blocks_of(page)])
        blocks = H.blocks_of(H._renamed(rng, page))
        assert [b[1] for b in blocks] == [b[1] for b in H.blocks_of(page)] and not any(H.taught(b[0]) for b in blocks)
        (scores,) = model.scores([H.vectors([blocks])])
        wrong, total, positive = wrong + int(((scores > 0) != labels).sum()), total + len(labels), positive + int(labels.sum())
    assert wrong <= 0.08 * total and positive >= 0.15 * total


def test_deep_and_long_pages_are_read_in_linear_time():
    import time

    def took(n):
        began = time.process_time()
        for page in ("<p>" + "<b>x " * n, "<div>x " * n, "<ul>" + "<div>" * n + "<li>x</li>" * n, "<a>" * n + "x</a>" * n):
            H.vectors([H.blocks_of(page)])
        return time.process_time() - began

    took(1000)
    assert took(40_000) < 40 * max(took(4_000), 0.02)
    deep = H.blocks_of("<div class='k'>" * 5000 + "words")
    assert len(deep) == 1 and len(deep[0][0].path()) == 5000 and deep[0][0].path()[0] == ("div", "k")
