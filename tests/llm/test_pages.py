"""Extraction on pages with known main text, and the parts it is made of."""

import itertools
import time

import numpy as np
import pytest

from tillcast.llm import boosting, dom, layouts, pages


@pytest.fixture(scope="module")
def trees():
    return pages.learned(pages.Extraction())


def test_unseen_made_up_pages(trees):
    right = 0
    for number in range(50_000, 50_150):
        html = layouts.Page(number).made()
        truth = [n.text.replace(layouts.MARK, "") for n in dom.parse(html) if layouts.MARK in n.text]
        right += pages.extract_all([html.replace(layouts.MARK, "")], trees)[0] == "\n".join(truth)
    assert right >= 138


PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><script>var t="<p>no</p>";</script>
<style>p{}</style></head><body><nav><ul><li><a href=/a>Home</a></li><li><a href=/b>News</a></li></ul></nav>
<div class="cookie-notice"><p>We use cookies to improve your visit. Accept all of them now.</p></div>
<article><h1>The   title &lt;here&gt;</h1><p><b>First paragraph &amp; more&nbsp;text, with words.<br><p>Second
paragraph, which is a little longer than the first one was.<script>x</script></p>
<ul><li>One point to make.</li><li>Another point to make.</li></ul></article>
<section id="comments"><h2>Comments</h2><div class="comment"><p>I liked this article a lot, thank you.</p></div></section>
<aside class="sidebar"><p>Related things to read.</p></aside><footer>&copy; Somebody. All rights.</footer>"""


def test_a_page_by_hand(trees):
    assert pages.extract_all([PAGE], trees) == [
        "The title <here>\nFirst paragraph & more text, with words.\nSecond paragraph, which is a little "
        "longer than the first one was.\nOne point to make.\nAnother point to make."
    ]


def test_odd_markup_does_not_break(trees):
    odd = [
        "", "plain", "<", "<p", "</p></p>", "<!-- open", "<script>never", "<a href='x", "<p>" * 3000 + "deep",
        "<div>" * 2000 + "deeper", "&#0; &#xD800; &bogus; &amp", "<p hidden>gone<p>here", "<table><tr><td>a<td>b<tr><td>c",
        "<li><li><li>", "a < b and c > d", "<svg><p>x</svg>y", "<b><p>x</b>y</p>", "\x00<p>\x00",
    ]
    assert len(pages.extract_all(odd, trees)) == len(odd)
    assert pages.extract_all([], trees) == []


def test_runs_and_blocks():
    nodes = dom.parse("<p>a<b>b</b> c<br>d<p>e</p>f<div>g<!-- h -->i</div>")
    assert [n.text for n in nodes if not n.tag] == ["ab c d", "e", "f", "gi"]
    assert [n.text for n in dom.parse("<tr><td>a<td>b</tr>x") if not n.tag] == ["a", "b", "x"]


def test_decoding_is_the_likeliest_consistent_labelling():
    chance = np.random.default_rng(2)
    for _ in range(60):
        n = int(chance.integers(1, 8))
        parents = [-1] + [int(chance.integers(0, i)) for i in range(1, n)]
        is_run = [i not in parents for i in range(n)]
        odds = chance.normal(size=n) * 2
        yes, no = -np.logaddexp(0, -odds), -np.logaddexp(0, odds)
        best, labels = -np.inf, None
        for guess in itertools.product((False, True), repeat=n):
            holds = all(
                is_run[i] or guess[i] == any(guess[c] for c in range(n) if parents[c] == i)
                for i in range(n)
            )
            value = sum(yes[i] if g else no[i] for i, g in enumerate(guess))
            if holds and value > best:
                best, labels = value, list(guess)
        assert pages.decoded(parents, odds, is_run) == labels


def test_boosting_learns_a_rule():
    chance = np.random.default_rng(4)
    x = chance.normal(size=(2000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    fitted = boosting.fit(x[:1500], y[:1500], boosting.Boosting(columns=1.0))
    assert ((fitted.scores(x[1500:]) > 0) == y[1500:]).mean() > 0.95


def test_query_columns(spark):
    frame = spark.createDataFrame([(1, None), (2, ""), (3, PAGE), (3, PAGE)], "id long, html string")
    rows = frame.select("id", pages.main_text(spark).alias("text")).collect()
    assert [r.text for r in rows[:2]] == ["", ""] and rows[2].text == rows[3].text != ""
    empty = frame.where("false")
    assert empty.select(pages.main_text(spark)).collect() == []


def test_only_hidden_elements_are_dropped():
    def said(html):
        return " ".join(node.text for node in dom.parse(html) if not node.tag)

    for shown in (
        'title="the hidden cost"', 'class="x hidden md:block"', 'data-hidden="1"', "aria-hidden=false",
        'title="display: none"', 'title="aria-hidden=true"',
    ):
        assert said(f"<div {shown}><p>kept words</p></div>") == "kept words"
    for hidden in (
        "hidden", 'class="a" hidden=""', "HIDDEN id=x", 'aria-hidden="true"', "style='color:red; Display : none'",
    ):
        assert said(f"<div {hidden}><p>lost</p></div><p>after</p>") == "after"
        assert said(f"<p><span {hidden}>lost</span>after</p>") == "after"
    formula = "<math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>TeX</annotation></math>"
    assert said(f"<p>let {formula} hold</p>") == "let x=1 hold"
    assert said("<p>see <video src=a>a film</video> and <object>a picture</object></p>") == "see a film and a picture"


@pytest.mark.parametrize(
    "html",
    ["<div>" * 200_000 + "deep", "<b>" * 180_000 + "</i>" * 120_000, "<i><div>" + "<b>" * 160_000 + "</i>" * 120_000,
     "<li><ul>" + "<div>" * 70_000 + "<li></li>" * 70_000],
    ids=["nested", "stray ends", "ends of outer elements", "items far from their list"],
)
def test_a_megabyte_of_tags_takes_seconds(html):
    started = time.process_time()
    assert dom.parse(html)[0].tag == "html"
    assert time.process_time() - started < 30  # hours, if each tag looked at all open ones


def test_a_page_starts_anew_with_its_body():
    nodes = dom.parse("<div hidden><b>unseen</b><body>seen<p>too</p>")
    assert [n.text for n in nodes if not n.tag] == ["seen", "too"]
