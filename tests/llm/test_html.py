"""HTML extraction on pages as they are met: wrappers with telling names, optional end tags."""

import pytest

from ledgerline.llm import html_text

LONG = "A story line of many words that goes on for long enough to be taken as the main text of a page."


def _text(page):
    return html_text.between_surge_and_dive(html_text.page_lines(page))


@pytest.mark.parametrize("wrapper", ["div class='layout no-sidebar'", "div class='content with-sidebar'", "div class='page-widget'", "section class='social-studies'", "div class=sidebar", "form id=login"])
def test_wrappers_keep_their_article(wrapper):
    tag = wrapper.split()[0]
    assert _text(f"<{wrapper}><article><p>{LONG}</article></{tag}>") == [LONG]
    assert _text(f"<{wrapper}><p>{LONG}<p>{LONG}</{tag}>") == [LONG, LONG]


def test_named_boxes_beside_the_text_go():
    for name in ("sidebar", "sidebar-left", "cookie-notice", "related_list", "big ad-slot"):
        assert _text(f"<article><p>{LONG}</article><div class='{name}'>{LONG[:40]}</div>") == [LONG]
        assert _text(f"<div><p>{LONG}<p>{LONG}</div><div class='{name}'>{LONG}</div>") == [LONG, LONG]


@pytest.mark.parametrize("page", ["<article><ul><li class=ad>bad<li>{0}</ul><p>{0}</article>", "<article><ul><li>{0}<li class=ad>bad</ul><p>{0}</article>", "<article><dl><dt>{0}<dd class=ad>bad</dl>{0}</article>", "<article><table><tr><td class=ad>bad<td>{0}<tr class=ad><td>bad</table>{0}</article>"])
def test_a_skipped_element_ends_without_its_end_tag(page):
    assert _text(page.format(LONG)) == [LONG, LONG]


def test_lines_outside_a_teaser_card_are_decided_on_too():
    story = [f"{k} {LONG}" for k in range(6)]
    assert _text("<article class=card>Teaser</article>" + "".join(f"<div>{x}</div>" for x in story)) == story


def test_surge_decides_beside_an_article():
    page = f"<article><h1>Head</h1>{'<p>' + LONG:s}<p>{LONG}<p>End</article><div>Tail</div><div>" + "</div><div>".join([LONG * 4] * 3) + "</div>"
    assert _text(page) == ["Head", LONG, LONG, "End", "Tail", LONG * 4, LONG * 4, LONG * 4]
    assert _text(f"<article><h1>Head</h1><p>{LONG}<p>End</article><div>Tail</div>") == ["Head", LONG, "End"]


def test_short_articles_beside_the_longest_count_less():
    assert _text(f"<article><p>{LONG * 5}<p>End</article><div>x</div><article>Card</article>") == [LONG * 5, "End"]
    posts = [f"<article><h2>{k}</h2><p>{LONG}</article>" for k in range(3)]
    assert _text("".join(posts)) == ["0", LONG, "1", LONG, "2", LONG]


@pytest.mark.parametrize("attribute", ["data-x=it's", "title=\"it's > that\"", "data-x='a > \"b'", "data-x", "data-x=", "'", "a=b=c'"])
def test_quotes_open_values_only_behind_an_equals_sign(attribute):
    assert _text(f"<article><p>{LONG}</p><p {attribute}>{LONG}</p><p>it's {LONG}</p></article>") == [LONG, LONG, f"it's {LONG}"]


@pytest.mark.parametrize("attributes", ["style='overflow: hidden'", "title='a hidden gem'", "data-hidden='false'", "data-class='ads'", "data-role=navigation", "alt='role=alert hidden'", "aria-hidden='false'", "style=\"overflow:hidden"])
def test_only_an_attribute_of_that_name_counts(attributes):
    if attributes.count('"') == 1:  # never closed: all the rest of the page is its value
        assert _text(f"<article><p>{LONG}</p></article><div {attributes}><p>{LONG}") == [LONG]
        return
    assert _text(f"<div {attributes}><p>{LONG}</p><p>{LONG}</p></div>") == [LONG, LONG]
    assert _text(f"<article><p>{LONG}</p><div {attributes}>{LONG}</div></article>") == [LONG, LONG]


@pytest.mark.parametrize("attributes", ["hidden", "HIDDEN=''", "class='x ads' id=y", "aria-hidden=TRUE", "title='x' role=navigation"])
def test_marked_elements_go(attributes):
    assert _text(f"<article><p>{LONG}</p><p>{LONG}</p><div {attributes}>{LONG}</div></article>") == [LONG, LONG]


def test_inline_elements_do_not_cut_a_block():
    assert _text(f"<article><p>{LONG} <span style='visibility:hidden'>and</span> {LONG}</p></article>") == [f"{LONG} and {LONG}"]
    assert _text(f"<article><p>{LONG} <span hidden>not this</span> {LONG}</p></article>") == [f"{LONG} {LONG}"]
    assert _text(f"<article><p>{LONG}<button>Share</button> <b class=ad>Buy</b>&amp; <i>more</i></p></article>") == [f"{LONG} & more"]
    assert _text(f"<article><p>{LONG}</p><a class=promo><div>{LONG}</div></a><p>{LONG}</p></article>") == [LONG, LONG]


def test_odd_pages():
    assert _text(f"<p>{LONG}<!-- never closed <p>{LONG}") == [LONG]
    assert _text(f"<p>{LONG}</p><p title='never closed>{LONG}</p>") == [LONG]
    assert _text("<p></p>" * 50_000 + f"<p>{LONG} &#233;&eacute;&nbsp;x" + "</div>" * 50_000) == [f"{LONG} éé x"]
    assert len(_text("<article>" + f"<p>{LONG}</p>" * 20_000 + "</article>")) == 20_000


def test_the_distribution_decides():
    """Without articles, short lines on their own go and long ones stay, wherever they stand."""
    lines = ["Home", "News", LONG, LONG, "By the author", LONG, "Next", "Top", "Legal", "Contact"]
    page = "".join(f"<div>{x}</div>" for x in lines)
    assert _text(page) == lines[:8]  # the window of three reaches two lines beyond a long one
    assert _text("".join(f"<div>{x}</div>" for x in ["Home", "News", "Top", "Next"])) == []


def test_repeated_pages(spark):
    page = f"<article><p>{LONG}</p></article>"
    found = html_text.extract(spark.createDataFrame([(1, page), (1, page), (2, None)], "page_id int, html string")).collect()
    assert sorted((r.page_id, r.n_chars) for r in found) == [(1, len(LONG)), (1, len(LONG)), (2, 0)]
