"""Layouts of articles and boilerplate that no page of the tables has, by a model that is trained on theirs."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from silverloom.llm import html

DATA = os.environ.get("TEST_LABELLED_DIR", "/root/testdata/sf0.01")
BEFORE = "<p>" + "The ferry leaves the harbour at dawn, and returns late. People wait on the quay, with bags and boxes, for its call. " * 2 + "</p>"
AFTER = "<p>Later, the captain said that winds were mild, and that the sea was calm. Nobody on board was hurt, he added, and all went home.</p>"
AROUND = [("article", ""), ("main", ""), ("div", ' class="post-content"')]


@pytest.fixture(scope="module")
def model(spark):
    return html.train(spark.read.parquet(f"{DATA}/pages.parquet"))


def page(inner, behind, tag, attrs):
    menu = "<nav><ul><li><a href='/'>Home</a></li><li><a href='/a'>About</a></li></ul></nav>"
    return f"<html><body>{menu}<{tag}{attrs}><h1>A day at sea</h1>{BEFORE}{inner}{AFTER}</{tag}>{behind}<footer>&copy; someone</footer></body></html>"


def lines(model, *at):
    text = model.extract([page(*at)])[0]
    assert text.startswith("A day at sea\nThe ferry leaves") and "all went home." in text and "Home" not in text and "someone" not in text
    return text


@pytest.mark.parametrize(("tag", "attrs"), AROUND)
@pytest.mark.parametrize(
    "inner",
    [
        "<p><a href='/1'>KEEP</a> <a href='/2'>KEEP more words</a></p>", "<ul><li><a href='/1'>KEEP</a></li><li><a href='/2'>KEEP more words</a></li></ul>",
        "<table><tr><td><a href='/1'>KEEP</a></td><td><a href='/2'>KEEP more words</a></td></tr></table>", "<details><summary>KEEP this</summary><p>KEEP and some more text, of this kind.</p></details>",
        "<p>It was said, as <span class='related'>KEEP these words</span> showed, that all went well.</p>", "<ol><li><a href='/1'>KEEP</a></li><li><a href='/2'>KEEP more words</a></li></ol>",
        "<pre><code>KEEP = 1</code></pre>", "<blockquote><p><a href='/1'>KEEP the word</a></p></blockquote>",
    ],
)
def test_text_of_an_article_stays(model, inner, tag, attrs):
    assert lines(model, inner, "", tag, attrs).count("KEEP") == inner.count("KEEP")


COMMENTS = "<ul><li><p>DROP I liked this, thanks a lot.</p></li><li><p>DROP So did I, and my friends as well.</p></li></ul>"


@pytest.mark.parametrize(("tag", "attrs"), AROUND)
@pytest.mark.parametrize(
    "boilerplate",
    [
        f"<section class='comments'>{COMMENTS}</section>", f"<div class='comments'>{COMMENTS}</div>", f"<div class='comments-area'>{COMMENTS}</div>", f"<section id='comments'>{COMMENTS}</section>",
        "<section><h2>3 Comments</h2><p>DROP I liked this, thanks a lot.</p><p>DROP So did I.</p></section>", "<ol class='comment-list'><li><p>DROP fine words, these.</p></li></ol>",
        "<aside><p>DROP this is beside the text, and of no use.</p></aside>", "<div class='cookie-bar'><p>DROP We use cookies, as all do. <button>OK</button></p></div>",
    ],
)
def test_boilerplate_goes(model, boilerplate, tag, attrs):
    assert "DROP" not in lines(model, boilerplate, "", tag, attrs) and "DROP" not in lines(model, "", boilerplate, tag, attrs)


def test_related_links_go(model):
    related = "<h2>DROP Related</h2><ul><li><a href='/1'>DROP other things</a></li><li><a href='/2'>DROP more of them</a></li></ul>"
    assert all("DROP" not in lines(model, "", related, tag, attrs) for tag, attrs in AROUND)


def test_an_articles_own_header_goes(model):
    header = "<header><h2>DROP Title</h2><p>By DROP</p></header>"
    assert "DROP" not in lines(model, header, "", "article", "")


def test_the_fit_raises_the_likelihood():
    """The slopes are those of the likelihood: after the fit the labels are likelier than after half of it."""
    examples = [(t, html.labels_of(t)) for t in map(html.Tree, html.variants(html.STAND_IN))]

    def log_likelihood(model):
        return sum(float(np.log(m[np.arange(len(y)), y] + 1e-300).sum()) for m, (_, y) in zip(model.marginals([t for t, _ in examples]), examples, strict=True))

    few, more = html.Model(examples, rounds=8), html.Model(examples, rounds=60)
    assert log_likelihood(more) > log_likelihood(few)
    assert more.pair[html.BOILERPLATE, html.CONTENT] == html.NEVER


def test_the_model_does_not_grow_with_the_pages(spark):
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    twice = pages.unionByName(pages.withColumn("html", F.concat("html", F.lit(" "))))
    assert len(html.train(twice).weight) < 3 * len(html.train(pages).weight)
