"""Main text of pages and the quality classifier."""

import time

import pytest

from tickloom.llm import html_extract, queries, rule_ensemble

TREE = html_extract.grow(list(html_extract.LABELLED))
LONG = "Words of a long paragraph that goes on and on about one thing and then about another one, so that it is text. "


@pytest.mark.parametrize(("html", "text"), [
    ("", ""),
    ("plain", ""),
    (f"<article><h1>A &amp; B</h1><p>One.</p><p>{LONG * 2}</p></article>", f"A & B One. {LONG * 2}".strip()),
    ("<nav><a href=1>Home</a></nav><article><p>Short</p></article><footer>&copy; us</footer>", "Short"),
    ("<article><p>a<br>b<b>c</b>\n d&nbsp;e &#8364; &lt;x&gt;</p></article>", "a bc d e € <x>"),
    ("<article><p>One<p>Two <b>three<p>four</article>", "One Two three four"),
    ("<article><script>var x = '<p>no</p>';</script><style>p{}</style><!-- <p>no --><p>Yes</p></article>", "Yes"),
    ("<article><p>Yes</p><form><p>Your mail</p></form><aside>More</aside><div class='share-bar'>Share</div></article>", "Yes"),
    ("<article><p>Yes</p><section id='comments'><p>" + LONG + "</p></section></article>", "Yes"),
    ("<div class='cookie-notice'>We use cookies</div><main><header><h1>T</h1></header><p>Yes</p></main>", "T Yes"),
    (f"<div class=menu><a href=1>A</a> <a href=2>B</a></div><div><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div><div>Imprint</div>", f"{LONG}Short. {LONG}".strip()),
    ("<article><p>1 < 2 and a <b", "1 < 2 and a"),
    ("<article><p title='a>b'>x</p></article>", "x"),
    ("<article><p>x<!-- open", "x"),
    ("<article>" + "<div>" * 3000 + "deep", "deep"),
])
def test_main_text(html, text):
    assert html_extract.main_text(html, TREE) == text


CARD = "<article><h3><a href=1>Another story of the day</a></h3><p>A short line on it.</p></article>"


@pytest.mark.parametrize(("around", "text"), [
    ("{}<article class='comment-body'><p>" + LONG + "</p></article>", ""),
    ("{}<article class='comment-body'><p>" + LONG * 9 + "</p></article>", ""),
    ("<aside><article><p>" + LONG + "</p></article></aside>{}", ""),
    (CARD + "{}" + CARD * 2, ""),
    ("<div>Imprint and more</div><article><p>Brief.</p></article>", "Brief."),
])
def test_articles_that_are_not_the_main_text(around, text):
    main = f"<div><h1>A title of it</h1><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div>"
    assert html_extract.main_text(around.format(main), TREE) == (text or f"A title of it {LONG}Short. {LONG}".strip())


@pytest.mark.parametrize("page", [
    "<main class='content with-sidebar'>{}</main>", "<div class='layout has-sidebar'>{}</div>", "<article class='post category-social'>{}</article>",
    "<article class='post category-legal'>{}</article>", "<div class='search-result'>{}</div>", "<article class='social'>{}</article>",
    "<div class='sidebar'><main>{}</main></div>", "<div id='widget'><article>{}</article></div><div>Imprint</div>",
    "<article><h2>On it</h2><div class='social'>{}</div></article>", "<main class='comments'>{}</main>", "<div class='page-with-comments'>{}</div>",
    "<article class='promoted'>{}</article>", "<div class='layout sidebar'>{}<div class='comment-list'><p>" + LONG * 9 + "</p></div></div>",
    "<div class='has-header'>{}</div>",
])
def test_names_do_not_bar_the_main_text(page):
    text = html_extract.main_text("<nav><a href=1>Home</a></nav>" + page.format(f"<p>{LONG * 2}</p>"), TREE)
    assert text.removeprefix("On it ") == (LONG * 2).strip()


@pytest.mark.parametrize("name", [
    "share-bar", "comment-body", "comments-area", "cookieNotice", "related-posts", "site-footer", "x nav", "newsletter_signup", "sidebar"])
def test_names_bar_the_rest(name):
    text = html_extract.main_text(f"<div><p>{LONG * 2}</p></div><div class='{name}'><p>{LONG}</p></div>", TREE)
    assert text == (LONG * 2).strip()


@pytest.mark.parametrize("name", ["ad", "promo", "newsletter", "comments"])
def test_names_bar_longer_texts_beside_an_article(name):
    assert html_extract.main_text(f"<div class='{name}'><p>{LONG * 3}</p></div><article><h1>A title</h1><p>Brief.</p></article>", TREE) == "A title Brief."


def test_tree_learns_its_table():
    assert all(html_extract.decide(TREE, row[:-1]) == row[-1] for row in html_extract.LABELLED)


def test_extract_rows(spark):
    rows = [(1, None, None, 5), (2, "u", "", 5), (None, "v", "<article><p>x</p></article>", 5), (2, "u", "", 5)]
    out = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text int"))
    assert sorted((r.page_id or 0, r.text) for r in out.collect()) == [(0, "x"), (1, ""), (2, ""), (2, "")]
    assert html_extract.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_pages_query(spark):
    out = queries.op1_block_tree(spark, "/root/testdata/sf0.001").collect()
    assert len(out) == 50 and all(r.n_chars == len(r.text) > 0 for r in out)
    assert not any("©" in r.text for r in out)


def test_held_out_accuracy(spark):
    scored = queries.op7_rule_ensemble(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = scored.join(labels, "doc_id").filter("held_out").collect()
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.95
    assert scored.count() == 1000 and scored.filter("NOT score BETWEEN 0 AND 1").count() == 0


LABELS = "doc_id long, quality int, toxic int"


def test_scores_of_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, "a", 1.0), (2, "", "b", 2.0), (None, "words here", "c", 3.0), (1, None, "a", 1.0), (3, "x" * 100000, "d", 4.0)],
        "doc_id long, text string, doc string, score double")
    labels = spark.createDataFrame([(2, 1, None), (2, 0, 0), (None, 1, 0), (3, 7, 0), (4, None, 0)], LABELS)
    model = rule_ensemble.train(docs, labels)
    out = rule_ensemble.score(docs, model)
    assert out.count() == 5 and out.filter("score IS NULL OR predicted IS NULL").count() == 0
    assert rule_ensemble.keep_good(docs, labels).columns == docs.columns
    empty = rule_ensemble.train(docs.limit(0), labels.limit(0))
    assert empty.rules == () and rule_ensemble.score(docs, empty).select("score").distinct().collect()[0].score == 0.5
    assert rule_ensemble.score(docs.limit(0), model).count() == 0


def test_training_is_bounded_and_leaves_the_fold_out(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "concat('text of ', id) AS text")
    labels = spark.range(3000).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS quality", "0 AS toxic")
    rows = rule_ensemble.training_rows(docs, labels, limit=500)
    assert rows.count() == 500
    assert rows.filter(rule_ensemble.held_out(rows.doc_id)).count() == 0


@pytest.mark.parametrize("html", ["<div>" * 100_000 + "</p>" * 100_000, "<p>x" * 50_000, "<div><li>x" * 50_000, "<b><p>" * 50_000 + "</i>" * 50_000])
def test_unclosed_elements_take_no_longer_each(html):
    started = time.time()
    html_extract.blocks_of(html)
    assert time.time() - started < 20
