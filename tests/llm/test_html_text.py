import html
import itertools
import re

import numpy as np

from strata.llm import html_text as H
from strata.llm.queries import REGISTRY


def marked_text(source):
    """What the article element of a page holds, by its markup."""
    found = re.search(r"<article>(.*)</article>", source or "", re.S)
    blocks = re.split(r"</?(?:p|h1)>", found[1]) if found else []
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in blocks]
    return "\n".join(b for b in blocks if b)


def test_whole_table_matches_its_article_markup(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = REGISTRY["op3_html_text"](spark, sf).collect()
    assert len(rows) == len(pages)
    assert all(r.url == pages[r.page_id].url and r.n_chars == len(r.text) for r in rows)
    assert np.mean([r.text == marked_text(pages[r.page_id].html) for r in rows]) >= 0.98


def test_held_out_layouts(spark):
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").orderBy("page_id").collect()]
    model = H.fit(pages[:120])
    maker = H._Layouts(H._pools(pages[150:]), 77)
    exact = []
    for blocks in maker.articles:
        page = maker.page(blocks)
        _, nodes = H.parse(page)
        want = "\n".join(nodes[0].blocks({id(x) for x in nodes if x.keep == "1"}))
        exact.append(H.main_texts([page.replace("data-keep", "data-x")], model)[0] == want)
    assert np.mean(exact) >= 0.85


def test_boosting_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3_000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 2] > 0.5)).astype(float)
    model = H.boost(x[:2_000], y[:2_000])
    assert np.mean((model.logit(x[2_000:]) > 0) == (y[2_000:] == 1)) > 0.95


def test_decoding_is_the_best_consistent_labelling():
    _, nodes = H.parse("<div><p>a</p><ul><li>b<li>c</ul></div><div>d</div>")
    rng = np.random.default_rng(3)
    place = {id(x): i for i, x in enumerate(nodes)}
    for _ in range(50):
        logits = rng.normal(size=len(nodes)) * 2
        best = max(
            (sum(-np.logaddexp(0, -s) if y else -np.logaddexp(0, s) for y, s in zip(labels, logits)), labels)
            for labels in itertools.product((0, 1), repeat=len(nodes))
            if labels[0] and all(labels[place[id(x.parent)]] or not y for x, y in zip(nodes[1:], labels[1:]))
        )[1]
        assert {id(x) for x, y in zip(nodes, best) if y} == H.decode(nodes, logits)


def test_parsing_of_broken_markup():
    text = lambda s: "\n".join(H.parse(s)[0].blocks())
    assert text("<p>a<p>b<br>c <b>d</p> e") == "a\nb c d\ne"
    assert text("<ul><li>x<li>y</ul>z<script>var p='</p>';</script><style>p{}") == "x\ny\nz"
    assert text("a &amp; b&#233;&nbsp;c<!-- <p>no</p> --> d") == "a & bé c d"
    assert text("<div><table><tr><td>1<td>2<tr><td>3</table></section></div>") == "1\n2\n3"
    assert text("x < y <p class='a>b'>q</p <p>r") == "x < y\nq"[:5] + "\n" + text("<p class='a>b'>q</p <p>r")
    assert text("<div>" * 5_000 + "deep") == "deep"


def test_raw_elements_left_open_or_self_closed_keep_the_page():
    text = lambda s: "\n".join(H.parse(s)[0].blocks())
    assert text("<head><title>x</title><body><article><p>Body") == "Body"
    assert text("<head><title>x<body><p>Body") == "Body"
    assert text("<head><title>x</title><script>'<p>no'</script><p>Body</p>") == "Body"
    assert text("<p>One <svg/> two.</p><p>Three.") == "One two.\nThree."
    assert text("<p>One <svg><text>no</text></svg> two <iframe src='x' /> three") == "One two three"
    assert text("<head-line>Kept</head-line><button-group>too</button-group><p>Three.") == "Kepttoo\nThree."
    assert text("<p>If <math><mi>x</mi></math>, <object>one</object> <audio>two</audio> <video>three</video>.") == "If x, one two three."
    assert text("<button>Go<p>Body</p><button>x</button><p>End") == "Body\nEnd"
    assert text("<button>Go <p>Body" * 2_000) == "\n".join(["Body"] * 2_000)


def test_odd_rows(spark):
    some = [r.html for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").limit(20).collect()]
    rows = [(i, "u", h, "x") for i, h in enumerate(some)] + [(90, None, None, None), (91, "u", "", None), (None, "u", "<nav><a href=/>x</a></nav>", None)]
    rows += [(92, "u", some[0], None)] * 2 + [(93, "u", "<article>" + "<p>Long words stand here, quite so.</p>" * 20_000 + "</article>", None)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = H.extract(frame).collect()
    assert len(got) == len(rows)
    assert all(r.text == "" and r.n_chars == 0 for r in got if r.page_id in (90, 91))
    assert len({r.text for r in got if r.page_id in (0, 92)}) == 1
    assert next(r.n_chars for r in got if r.page_id == 93) == 20_000 * 33 - 1
    assert H.extract(frame.limit(0)).count() == 0
    assert H.extract(frame.where("html IS NULL")).first().text == ""


def test_very_long_pages_without_an_end_of_a_tag():
    import time

    started = time.time()
    for page in ("<div" * 250_000, "<script " * 125_000, "<p>text</p>" + "<a href='x' " * 80_000, "<p>a</p>" + "<" * 1_000_000):
        nodes = H.parse(page)[1]
        assert len(nodes) <= 2
    assert time.time() - started < 20
    assert list(H.parse("<p>one</p> two <!-- no end")[0].blocks()) == ["one", "two"]
    assert list(H.parse("<p>one <!-- > no end </p> still")[0].blocks()) == ["one"]
    assert list(H.parse("<p>one</p> 1 < 2")[0].blocks()) == ["one", "1 < 2"]
