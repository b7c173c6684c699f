import html
import re

import numpy as np
import pytest

from flowvigil.llm import extraction, queries

FOLDER = "/root/testdata/sf0.001"


def gold(page):
    """Blocks of the one article of a given page, by its tags."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
    return "\n".join(x for x in blocks if x)


def test_given_pages(spark):
    got = {r.page_id: r for r in queries.op8_html_extraction(spark, FOLDER).collect()}
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").collect()
    assert len(got) == len(pages)
    for p in pages:
        assert got[p.page_id].url == p.url and got[p.page_id].n_chars == len(got[p.page_id].text)
        assert got[p.page_id].text == gold(p.html)


def test_leaves_by_hand():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="Home page">
    <script>var t="</p>x<b";</script><!-- <p>no</p> --><nav><ul><li><a href="/">One</a><li><a>Two
    </a></ul></nav><div id=main><p>A &amp; <b>b</b>&nbsp;c<br>d<p>1 < 2 and 3 > 2</div>tail"""
    found = extraction.leaves(page)
    assert [x.text for x in found] == ["One", "Two", "A & b c d", "1 < 2 and 3 > 2", "tail"]
    assert found[0].linked and not found[2].linked
    assert "main" in found[2].path and "<nav" in found[0].path and "home" in found[4].path


@pytest.mark.parametrize("page", ["", " \n", "<", "<p", "<!--", "<script>", "</p></div>", "<p>a</b></p", 'x<a href="', "&#0;&#xD800;&bogus;"])
def test_broken_pages_do_not_crash(page):
    extraction.encode(extraction.leaves(page))


def test_odd_rows(spark, staging):
    long_page = "<article>" + "".join(f"<p>Paragraph {i} of a very long page.</p>" for i in range(20_000)) + "</article>"
    given = [r for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()]
    rows = [(r.page_id, r.url, r.html, 1) for r in given]
    rows += [(900, None, None, 1), (901, "u", "", 1), (None, None, long_page, 1), *[(1, "u", rows[0][2], 1)] * 2]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text int")
    labeller = extraction.fit(pages, staging)
    got = extraction.extract(pages, labeller).collect()
    assert [(r.page_id, r.url) for r in got] == [r[:2] for r in rows]
    by_place = dict(zip(range(len(rows)), got))
    n = len(given)
    assert by_place[n].text == by_place[n + 1].text == "" and by_place[n].n_chars == 0
    assert by_place[n + 2].text.count("\n") == 19_999
    assert by_place[n + 3].text == by_place[n + 4].text == gold(rows[0][2])
    assert extraction.extract(pages.limit(0), labeller).count() == 0


def test_fit_without_pages(spark, staging):
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert extraction.extract(pages, extraction.fit(pages, staging)).count() == 0


def test_gradients_match_differences():
    """Back-propagation through both directions against finite differences."""
    page = extraction.encode(extraction.leaves("<nav><li>a b</li></nav><article><p>C d.</p><p>e f g!</p></article>"))
    model = extraction.Labeller()
    for k in model.p:
        model.p[k] = model.p[k].astype(np.float64)
    y = np.array([0.0, 1.0, 1.0])

    def loss():
        x = model.inputs(page)[:, None, :].astype(np.float64)
        mask = np.ones((3, 1))
        forth, a = model._run(x, mask, "forth", True)
        back, b = model._run(x[::-1], mask[::-1], "back", True)
        seen = np.concatenate([forth, back[::-1], x], axis=2)
        z = (seen @ model.p["out"] + model.p["bias"])[:, 0]
        return float(np.logaddexp(0, -np.where(y == 1, 1, -1) * z).mean()), (x, a, b, z)

    _, (x, tape_f, tape_b, z) = loss()
    error = ((1 / (1 + np.exp(-z)) - y) / 3)[:, None]
    d_seen = error[:, :, None] * model.p["out"]
    h = extraction.HIDDEN
    grads = {k: np.zeros_like(v) for k, v in model.p.items()}
    model._run_back(x, "forth", tape_f, d_seen[:, :, :h], grads)
    model._run_back(x[::-1], "back", tape_b, d_seen[::-1, :, h : 2 * h], grads)
    for name in ("forth_x", "forth_h", "forth_b", "back_x", "back_h", "back_b"):
        flat = model.p[name].reshape(-1)
        for at in range(0, flat.size, max(1, flat.size // 7)):
            kept = flat[at]
            flat[at] = kept + 1e-3
            above = loss()[0]
            flat[at] = kept - 1e-3
            below = loss()[0]
            flat[at] = kept
            assert grads[name].reshape(-1)[at] == pytest.approx((above - below) / 2e-3, abs=2e-4)


@pytest.mark.parametrize(
    "page, texts",
    [
        ("<article><p>one</p><svg viewBox='0 0 1 1'/><p>two</p></article>", ["one", "two"]),
        ("<head><title>T</title><meta charset=utf-8><p>one<p>two", ["one", "two"]),
        ("<head><title>T</title><link rel=x href=y><body><p>one", ["one"]),
        ("<head><title>T</title> text<p>one", ["text", "one"]),
        ("<head><title>a <b> c</title><noscript><p>no</p></noscript></head><p>one", ["one"]),
        ("<p>one</p><svg-icon name=x></svg-icon><video-player></video-player><object-x></object-x><p>two</p>", ["one", "two"]),
        ("<header>h</header><p>one</p>", ["h", "one"]),
        ("<p>if <math><mi>x</mi><mo>=</mo><mn>2</mn></math> then", ["if x=2 then"]),
        ("<p>one</p><svg><title>t</title><g><path/></g><text>no</text></svg><p>two</p>", ["one", "two"]),
        ("<div><svg><path></div><p>two</p>", ["two"]),
        ("<svg><path><p>two</p>", ["two"]),
        ("<svg><foreignObject><p>no</p></foreignObject></svg><p>two</p>", ["two"]),
        ("<p>one</p><template><div><template>no</template>no</div></template><video><p>no</p></video><p>two</p>", ["one", "two"]),
    ],
)
def test_only_what_is_not_shown_is_left_out(page, texts):
    assert [x.text for x in extraction.leaves(page)] == texts


@pytest.mark.parametrize(
    "page, texts",
    [
        ("<p>one</p><script type=\"a>var x = 1;</script><p>two</p>", ["one", "two"]),
    ],
)
def test_torn_tags(page, texts):
    assert [x.text for x in extraction.leaves(page)] == texts


def inside_article(page, at, more):
    cut = page.index(at) + (0 if at.startswith("</") else len(at))
    return page[:cut] + more + page[cut:]


#: One change to a given page each; ``None``: the article's text stays as it is.
VARIANTS = {
    "as given": (lambda p: p, None),
    "classes of body": (lambda p: re.sub(r"<body[^>]*>", '<body class="has-sidebar no-banner">', p), None),
    "wrapped in a form": (lambda p: re.sub(r"(<body[^>]*>)(.*)(</body>)", r'\1<form id="aspnet">\2</form>\3', p, flags=re.S), None),
    "wrapped with classes": (lambda p: re.sub(r"(<body[^>]*>)(.*)(</body>)", r'\1<div class="page with-comments no-ads">\2</div>\3', p, flags=re.S), None),
    "article in content": (lambda p: p.replace("<article>", '<div id="content"><article>').replace("</article>", "</article></div>"), None),
    "no end of head": (lambda p: p.replace("</head>", ""), None),
    "empty svg": (lambda p: inside_article(p, "<article>", "<svg viewBox='0 0 1 1'/>"), None),
    "custom element": (lambda p: inside_article(p, "<article>", "<svg-icon></svg-icon>"), None),
    "comments inside": (lambda p: inside_article(p, "</article>", '<div class="comments"><p>First!</p><p>I do not agree.</p></div>'), None),
    "sidebar inside": (lambda p: inside_article(p, "</article>", '<div class="sidebar"><ul><li><a href="/">More</a></li></ul></div>'), None),
    "pre, list and table": (
        lambda p: inside_article(p, "<article>", "<pre>some code of it</pre><ul><li>a point of the list</li></ul><table><tr><td>a cell of the table</td></tr></table>"),
        "some code of it\na point of the list\na cell of the table\n",
    ),
}


@pytest.fixture(scope="module")
def fitted(spark, tmp_path_factory):
    from flowvigil.staging import Staging

    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    return extraction.fit(pages, Staging(spark)), [r.html for r in pages.collect()]


@pytest.mark.parametrize("name", VARIANTS)
def test_no_article_is_lost_to_its_surroundings(fitted, name):
    labeller, pages = fitted
    change, more = VARIANTS[name]
    read = [extraction.leaves(change(p)) for p in pages]
    found = labeller.logits([extraction.encode(x) for x in read])
    texts = ["\n".join(x.text for x, good in zip(page, own) if good > 0) for page, own in zip(read, found)]
    wrong = [(text, (more or "") + gold(page)) for text, page in zip(texts, pages) if text != (more or "") + gold(page)]
    assert not wrong, (len(wrong), len(pages), wrong[0])
