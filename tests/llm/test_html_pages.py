"""Whole small pages: what belongs to the article stays, what does not goes, in time linear in the page."""

import random
import time

import pytest

from almanac.llm import html_text

from .conftest import SMALL

PARAGRAPHS = [f"Paragraph number {n} of the article says quite a few plain words about one thing and another." for n in ("one", "two", "three", "four")]
BODY = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
OPENINGS = [("<article>", "</article>"), ("<main>", "</main>"), ("<div id='content'>", "</div>")]


@pytest.fixture(scope="module")
def weights(spark):
    return html_text.learn(spark.read.parquet(f"{SMALL}/pages.parquet"))


def text_of(weights, inside, around=("<article>", "</article>"), after=""):
    return html_text.main_text(f"<html><body><nav><a href='/'>Home</a> <a href='/x'>Other</a></nav>{around[0]}{inside}{around[1]}{after}</body></html>", weights)


@pytest.mark.parametrize("around", OPENINGS)
def test_tables_lists_and_code_at_the_end_stay(weights, around):
    table = "<table><thead><tr><th>a</th><th>b</th></tr></thead><tbody>" + "".join(f"<tr><td>{i}</td><td>{i * i}</td></tr>" for i in range(6)) + "</tbody></table>"
    items = "<ul>" + "".join(f"<li>item{i}</li>" for i in range(5)) + "</ul>"
    got = text_of(weights, BODY + table + items + "<pre>x = 1</pre>", around)
    want = [*PARAGRAPHS, "a", "b", *[str(n) for i in range(6) for n in (i, i * i)], *[f"item{i}" for i in range(5)], "x = 1"]
    assert got == "\n\n".join(want)


@pytest.mark.parametrize("part", [
    "<section class='discussion'><h2>Discussion</h2><p>We find that it holds.</p></section>", "<section id='related-work'><p>Others did so before.</p></section>",
    "<div class='has-sidebar'><p>Still the text.</p></div>", "<div class='post-content with-comments'><p>Still the text.</p></div>",
    "<section id='notice'><p>Take note of this.</p></section>",
])
def test_sections_of_the_article_stay(weights, part):
    plain = "\n\n".join(t for t in part.replace("</h2>", "\n").replace("</p>", "\n").replace(">", "\n").split("\n") if t and "<" not in t)
    assert text_of(weights, BODY + part) == "\n\n".join(PARAGRAPHS) + "\n\n" + plain


@pytest.mark.parametrize("around", OPENINGS)
@pytest.mark.parametrize("part", [
    "<div id='comments' class='comments-area'><ol class='comment-list'><li>First! Great post.</li></ol></div>", "<section id='comments'><p>Great post.</p></section>",
    "<div class='related-posts'><p>See another one</p></div>", "<div class='share-buttons'><a href='#'>Share it</a></div>", "<div class='ad-slot'><p>Buy now</p></div>",
    "<div class='newsletter-box'><p>Get our mail</p></div>", "<div class='cookie-bar'><p>We use cookies</p></div>", "<noscript>Please turn it on</noscript>",
    "<div class='site-footer'><p>All rights reserved</p></div>", "<div id='fb-comments'>so true</div>", "<form><label>Name</label><input></form>",
    "<div style='display: none'>not shown</div>", "<div hidden>not shown</div>", "<aside><p>By the way</p></aside>", "<div role='complementary'>More</div>",
    "<section class='reader-comments'><article><p>I disagree with all of that.</p></article></section>",
])
def test_what_is_no_article_goes(weights, around, part):
    assert text_of(weights, BODY + part, around) == "\n\n".join(PARAGRAPHS)
    assert text_of(weights, BODY, around, after=part) == "\n\n".join(PARAGRAPHS)


def test_comments_that_outweigh_the_article_go(weights):
    comments = "<section class='comments'>" + "".join(f"<p>Comment number {i} is long and says the same as all of the others did before.</p>" for i in range(30)) + "</section>"
    assert text_of(weights, BODY + comments) == "\n\n".join(PARAGRAPHS)


def test_a_form_around_the_page_is_spared(weights):
    assert text_of(weights, BODY, ("<form action='/'><div class='layout has-sidebar'>", "</div></form>")) == "\n\n".join(PARAGRAPHS)


@pytest.mark.parametrize("tag", ["<p title=\"it\"s\">", "<p title='a>b'>", "<p title=\"a > b\" class=x>", "<p data-x=it's>", "<p '>", "<p title = \"q\"\">"])
def test_odd_quotes(weights, tag):
    assert text_of(weights, BODY + tag + "Last words here.</p><p>And the very last.</p>").endswith("\n\nLast words here.\n\nAnd the very last.")


@pytest.mark.parametrize("page", ["<form>" * 2_000 + "<p>some words</p>", "<div>" * 20_000 + "</p>" * 20_000 + "words", "<p title=\"" * 20_000, "<a href='" * 20_000 + ">",
                                  "<p>" * 50_000 + "x", "<ul><li>" * 10_000 + "y", "<!--" * 50_000, "&amp" * 100_000, "< " * 100_000])
def test_deep_and_broken_pages_take_linear_time(weights, page):
    start = time.perf_counter()
    html_text.main_text(page, weights)
    assert time.perf_counter() - start < 2


def test_the_run_of_a_page_is_the_best_of_all_runs(weights):
    pick = random.Random(8)
    parts = ["<p>", "</p>", "<li>", "<td>", "<div>", "</div>", "<a href=x>", "</a>", "word", "two words ", "<nav>", "</nav>", "<main>", "</main>", "<br>"]
    for _ in range(150):
        page = "".join(pick.choices(parts, k=pick.randrange(1, 25)))
        found = html_text.tokens(page)
        has_main = html_text._main_decides(found)
        scores = [weights.of(t, has_main) for t in found]
        best = max([sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)], default=0.0)
        start, stop = html_text.best_run(scores)
        assert sum(scores[start:stop]) == pytest.approx(max(0.0, best))
        blocks = {}
        for t in found[start:stop]:
            if t.text and not t.boiler:
                blocks.setdefault(t.block, []).append(t.text)
        want = "\n\n".join(x for x in (" ".join("".join(b).split()) for b in blocks.values()) if x)
        assert html_text.main_text(page, weights) == want


def test_places_do_not_hold_the_label(weights):
    assert all(place.count("|") == 1 for place in weights.words)
